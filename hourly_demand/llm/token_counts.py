"""Token counts by a tokenizer that is compiled to a finite-state transducer.

The tokenizer (BPE with word ends, a .json file) brings a text to normal form (NFC, lower case),
cuts it into words by a pattern and merges the bytes of a word pairwise. The transducer reads the
bytes of the normal form. Its states hold how far the pattern has come and what of the word can
still matter: for every start from which a piece may yet go on, the place in the trie of pieces, the
piece before that start, and the number of tokens up to there, less that of the shortest cut so
far. Which piece ends at a byte is decided by one rule: two pieces may stand side by side if no merge
across their border comes before the merges that made them. The tokens that a byte adds to (or takes
from) the count are written on its transition, so a count is the sum along the path. States are made
deterministic as texts need them and kept in a table that is bounded (TABLE_BYTES) and begun anew
when it is full.

Texts are cut into chunks of equal length at any byte. All chunks of a batch advance together, one
table lookup a byte for all of them. A chunk's map from entry state to (exit state, count) is
constant but for its head, the bytes before its first blank: so the maps are composed along each
text by running the heads from the exit states of the chunks before, all heads of a batch at once;
chunks without a blank pass their states on in rounds.

Strings of special tokens within a text are one token each, as is the tokenizer's default. A null
text is an empty one with no tokens. Repeated rows and extra columns stay; columns named n_bytes,
n_tokens or over_limit are replaced.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import slices, text_bytes, with_columns

LIMIT = 2048
CHUNK = 512
TABLE_BYTES = 160 << 20
#: Classes of characters.
BLANK, LETTER, NUMBER, OTHER, SPECIAL = range(5)
#: Stands for a special token in a text; no valid text holds it.
_MARK = "\ud800"
_NEVER = 1 << 30
#: The pattern of words that this compiler knows (fixed value of the tokenizer's file).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Endings after an apostrophe (fixed value, part of the pattern).
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def _byte_of() -> dict[str, int]:
    """Byte-level files write each byte as a printable character: itself or the next from U+0100."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pieces:
    """The merges: pieces by number (512 symbols, then one per merge), their trie and their parts.

    Symbols are the 256 bytes within a word, and the 256 bytes at its end, which carry the word end.
    """

    def __init__(self, merges: list, suffix: str):
        byte_of = _byte_of()
        number: dict[tuple, int] = {}

        def symbols(piece: str) -> tuple:
            ends = piece.endswith(suffix)
            found = [byte_of[c] for c in (piece[: -len(suffix)] if ends else piece)]
            return (*found[:-1], found[-1] + 256) if ends else tuple(found)

        for s in range(512):
            number[(s,)] = s
        self.parts: list[tuple[int, int]] = [(s, s) for s in range(512)]
        self.pair: dict[tuple[int, int], int] = {}
        for merge in merges:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = symbols(left), symbols(right)
            if a + b in number:
                raise ValueError("two merges make one piece")
            self.pair[number[a], number[b]] = number[a + b] = len(self.parts)
            self.parts.append((number[a], number[b]))
        self._lefts: dict[int, list[int]] = {}
        self._rights: dict[int, list[int]] = {}
        self._beside: dict[int, bool] = {}
        # A piece that the merges cannot reach on its own is no piece.
        whole = [True] * 512
        for p in range(512, len(self.parts)):
            a, b = self.parts[p]
            whole.append(whole[a] and whole[b] and self._stays(a, b, p))
        self.child: dict[int, int] = {}
        self.piece_at, self.leaf = [-1], [True]
        for piece, p in number.items():
            if whole[p]:
                node = 0
                for s in piece:
                    after = self.child.get(node << 9 | s)
                    if after is None:
                        after = self.child[node << 9 | s] = len(self.piece_at)
                        self.leaf[node] = False
                        self.piece_at.append(-1)
                        self.leaf.append(True)
                    node = after
                self.piece_at[node] = p

    def _edge(self, piece: int, side: int) -> list[int]:
        """The pieces at one edge of a piece as it was merged, from a symbol up to the piece."""
        kept = self._rights if side else self._lefts
        if piece not in kept:
            edge = [piece]
            while edge[-1] >= 512:
                edge.append(self.parts[edge[-1]][side])
            kept[piece] = edge[::-1]
        return kept[piece]

    def _stays(self, left: int, right: int, before: int = _NEVER) -> bool:
        """No merge across the border, made earlier than `before`, comes in time."""
        a, b = self._edge(left, 1), self._edge(right, 0)
        i = j = 0
        while True:
            next_a = a[i + 1] if i + 1 < len(a) else _NEVER
            next_b = b[j + 1] if j + 1 < len(b) else _NEVER
            across = self.pair.get((a[i], b[j]), _NEVER)
            # Of equal merges the one further left comes first.
            if across < next_a and across <= next_b and across < before:
                return False
            if next_a == next_b == _NEVER:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1

    def beside(self, left: int, right: int) -> bool:
        key = left << 20 | right
        found = self._beside.get(key)
        if found is None:
            if len(self._beside) > 2_000_000:
                self._beside.clear()
            found = self._beside[key] = self._stays(left, right)
        return found

    def advance(self, word: tuple, symbol: int) -> tuple[tuple, int]:
        """The state of a word after one more symbol, and the change of its number of tokens.

        A state is a set of (node, piece before, tokens before less those of the whole word so far).
        """
        child, piece_at = self.child, self.piece_at
        on, last, count = [], -1, 0
        for node, before, tokens in word:
            after = child.get(node << 9 | symbol)
            if after is None:
                continue
            p = piece_at[after]
            if p >= 0 and (before < 0 or self.beside(before, p)):
                last, count = p, tokens + 1
            if not self.leaf[after]:
                on.append((after, before, tokens))
        return (*[(n, b, t - count) for n, b, t in on], (0, last, 0)), count


_START = ((0, -1, 0),)


class Transducer:
    """Deterministic states, numbered as they are met, and the table of their transitions.

    A state is (mode, word without its last byte, last byte). The last byte waits, as only the next
    one tells whether it ends the word. State 0 is between words.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.class_of = np.full(0x110000, OTHER, np.uint8)
        for c in range(0x110000):
            kind = unicodedata.category(chr(c))[0]
            if kind in "LN":
                self.class_of[c] = LETTER if kind == "L" else NUMBER
        self.class_of[[i for i in range(0x3001) if regex.match(r"\s", chr(i)) and i not in range(0x1C, 0x20)]] = BLANK
        self.class_of[ord(_MARK)] = SPECIAL
        # Columns: a first byte of a character with its class, or a later byte, as they are met.
        self.columns = np.full(6 * 256, -1, np.int32)
        self.columns[: BLANK * 256 + 256] = 0
        self.clear()

    def clear(self) -> None:
        self.columns[256:] = -1
        self.meaning: list[tuple[int, int]] = [(BLANK, 32)]
        self.states: list[tuple] = [("", _START, -1)]
        self.number: dict[tuple, int] = {self.states[0]: 0}
        self.table = np.full((4096, 64), -1, np.int32)

    def _columns(self, key: np.ndarray) -> np.ndarray:
        found = self.columns[key]
        if len(found) and found.min() < 0:
            for new in np.unique(key[found < 0]).tolist():
                self.columns[new] = len(self.meaning)
                self.meaning.append(divmod(new, 256))
            found = self.columns[key]
        if len(self.meaning) > self.table.shape[1]:
            wider = np.full((len(self.table), len(self.meaning) + 32), -1, np.int32)
            wider[:, : self.table.shape[1]] = self.table
            self.table = wider
        return found

    def _ended(self, state: tuple) -> int:
        """Tokens that the end of the word in this state adds."""
        _, word, last = state
        return self.pieces.advance(word, last + 256)[1] if last >= 0 else 0

    def _pushed(self, state: tuple, byte: int, mode: str) -> tuple[tuple, int]:
        _, word, last = state
        if last < 0:
            return (mode, word, byte), 0
        word, count = self.pieces.advance(word, last)
        return (mode, word, byte), count

    def step(self, state: tuple, kind: int, byte: int) -> tuple[tuple, int]:
        """Next state and change of the count for a byte of a class; 5 for a later byte of a character."""
        mode, between = state[0], self.states[0]
        if kind == 5:  # of a blank, a special token, or the word's last character
            return (between, 0) if mode == "" else self._pushed(state, byte, mode)
        letter = chr(byte)
        if mode.startswith("'"):
            so_far = mode[1:] + letter
            if kind == LETTER and byte < 128 and any(e.startswith(so_far) for e in ENDINGS):
                after, count = self._pushed(state, byte, "'" + so_far)
                if so_far in ENDINGS:
                    return between, count + self._ended(after)
                return after, count
            if kind == OTHER and mode == "'":
                return self._pushed(state, byte, "o")
            if mode != "'":  # the letters after the apostrophe begin a word of their own
                count = self._alone(b"'") - self._counted("'" + mode[1:])
                letters = between
                for c in mode[1:].encode():
                    letters, more = self._pushed(letters, c, "l")
                    count += more
                after, more = self.step(letters, kind, byte)
                return after, count + more
        if kind == LETTER and mode == "l" or kind == OTHER and mode == "o":
            return self._pushed(state, byte, mode)
        count = self._ended(state)
        if kind == BLANK:
            return between, count
        if kind == SPECIAL:
            return between, count + 1
        mode = {LETTER: "l", NUMBER: "n", OTHER: "o"}[kind]
        after, more = self._pushed(between, byte, "'" if letter == "'" and kind == OTHER else mode)
        return after, count + more

    def _alone(self, word: bytes) -> int:
        state, count = self.states[0], 0
        for b in word:
            state, more = self._pushed(state, b, "o")
            count += more
        return count + self._ended(state)

    def _counted(self, word: str) -> int:
        """What an unfinished word has added so far."""
        state, count = self.states[0], 0
        for b in word.encode():
            state, more = self._pushed(state, b, "o")
            count += more
        return count

    def learn(self, places: np.ndarray) -> None:
        """Fills the transitions at these places of the flat table."""
        width = self.table.shape[1]
        for place in np.unique(places).tolist():
            at, column = divmod(place, width)
            state, count = self.step(self.states[at], *self.meaning[column])
            n = self.number.get(state)
            if n is None:
                n = self.number[state] = len(self.states)
                self.states.append(state)
                if n >= len(self.table):
                    self.table = np.concatenate((self.table, np.full_like(self.table[: len(self.table) // 4], -1)))
            self.table[at, column] = n << 8 | count + 128

    def run(self, columns: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exit states and counts of chunks: columns[i] holds byte i of every chunk."""
        total = np.zeros(columns.shape[1], np.int64)
        width = self.table.shape[1]
        for step in columns:
            at = state * width + step
            found = self.table.ravel().take(at)
            if len(found) and found.min() < 0:
                self.learn(at[found < 0])
                found = self.table.ravel().take(at)
            state = (found >> 8).astype(np.int64)
            total += (found & 255) - 128
        return state, total

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each normal text."""
        if self.table.nbytes > TABLE_BYTES:
            self.clear()
        parts, chunks = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            first = (data & 0xC0) != 0x80
            key = 5 * 256 + data.astype(np.int32)
            key[first] = self.class_of[codes].astype(np.int32) * 256 + data[first]
            chunks[i] = len(data) // CHUNK + 1
            padded = np.zeros(chunks[i] * CHUNK, np.int32)
            padded[: len(data)] = self._columns(key)
            parts.append(padded)
        if not parts:
            return chunks
        columns = np.ascontiguousarray(np.concatenate(parts).reshape(-1, CHUNK).T)
        of = np.repeat(np.arange(len(texts)), chunks)
        opening = np.zeros(len(of), bool)
        opening[np.cumsum(chunks) - chunks] = True
        # The head of a chunk ends with its first blank; the first chunk of a text has none.
        blank = columns == 0
        head = np.where(blank.any(axis=0), blank.argmax(axis=0), CHUNK)
        head[opening] = 0
        inside = np.arange(CHUNK)[:, None] < head[None, :]
        exits, total = self.run(np.where(inside, 0, columns), np.zeros(len(of), np.int64))
        # Heads run from the exit state of the chunk before, as soon as that is known.
        known = head < CHUNK
        todo = np.flatnonzero(head > 0)
        # A chunk that begins with a blank still has to end the word before it.
        todo = np.union1d(todo, np.flatnonzero(~opening))
        while len(todo):
            now = todo[known[todo - 1]]
            longest = min(CHUNK, int(head[now].max()) + 1)
            out, more = self.run(np.where(np.arange(longest)[:, None] <= head[now], columns[:longest, now], 0), exits[now - 1])
            total[now] += more
            through = now[head[now] == CHUNK]
            exits[through] = out[head[now] == CHUNK]
            known[through] = True
            todo = np.setdiff1d(todo, now, assume_unique=True)
        return np.bincount(of, total, len(texts)).astype(np.int64)


class Tokenizer:
    """What the .json file says, as far as this compiler knows it; other files are refused."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, cut = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        known = model["type"] == "BPE" and not model.get("byte_fallback") and not model.get("ignore_merges")
        if not known or steps != ["NFC", "Replace", "Lowercase"] or cut["pattern"]["Regex"] != WORDS:
            raise ValueError("this tokenizer is not one that can be compiled")
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.transducer = Transducer(Pieces(model["merges"], model["end_of_word_suffix"]))
        self.find = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def normal(self, text: str) -> str:
        """NFC and lower case, character by character; special tokens as one mark."""
        if self.find is not None and any(s in text for s in self.special):
            text = self.find.sub(_MARK, text)
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            # A capital sigma is lower-cased without regard to its place.
            text = text.replace("Σ", "σ")
        return text.lower()

    def count(self, texts: list[str]) -> np.ndarray:
        return self.transducer.count([self.normal(t) for t in texts])


def _tokenizer(text: str) -> Tokenizer:
    """Kept for the life of a Python worker, with the states it has learned."""
    kept = sys.__dict__.setdefault("_compiled_tokenizers", {})
    if text not in kept:
        kept.clear()
        kept[text] = Tokenizer(text)
    return kept[text]


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """docs with n_bytes, n_tokens and over_limit (n_tokens > limit); tokenizer is the path of the file on the driver."""
    with open(tokenizer, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    added = {"n_bytes": T.LongType(), "n_tokens": T.LongType(), "over_limit": T.BooleanType()}
    fields = [f for f in docs.schema.fields if f.name not in added]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = _tokenizer(shared.value)
        for batch in batches:
            for part in slices(batch, text, 2 << 20):
                column = part.column(text)
                sizes = np.diff(text_bytes(column)[1])
                n = compiled.count([t or "" for t in column.to_pylist()])
                yield with_columns(part, {"n_bytes": pa.array(sizes, pa.int64()), "n_tokens": pa.array(n, pa.int64()), "over_limit": pa.array(n > limit)})

    return docs.mapInArrow(counted, T.StructType([*fields, *[T.StructField(k, v) for k, v in added.items()]]))
