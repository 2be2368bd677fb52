"""Byte-level BPE with the vocabulary file of a public tokenizer (its path is a parameter).

A short word is encoded over two lists, its part boundaries' bytes and the rank of each adjacent pair: scan for the
smallest rank, delete that boundary, refresh the two ranks beside it, until no pair has a rank. Long words use a heap
with the same order (rank, then place), so that time stays near linear. A bounded memo keeps the ids of frequent pieces.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from blockwright.llm.arrays import slices
from blockwright.llm.shared import with_text

SHORT = 96
MEMO = 250_000  # pieces of a generation
PIECES_AT_ONCE = 4096
MEMO_LETTERS = 48  # longer pieces are rare and aren't kept, which bounds the memo in bytes
COLUMN_BYTES = 4 << 20
OLD_LETTERS = r"A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}\x{400}-\x{481}"  # letters in every version of Unicode that a library may hold
#: White space other than one blank or line feed between two other characters, and the mark that cuts pieces.
ODD_SPACE = r"[\x00\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|[ \n][ \n]|\A[ \n]|[ \n]\z"
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def evenly_spaced(text: str) -> bool:
    """Whether all white space is one blank or line feed between two other characters; else the pattern itself is needed."""
    words = text.split()
    blank = len(text) - sum(map(len, words))
    return blank == len(words) - 1 == text.count(" ") + text.count("\n") and "\0" not in text


def byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Memo(dict):
    """A mapping filled on demand, of two generations: when the young one is full, the old one goes."""

    def __init__(self, make: Callable[[str], bytes], most: int = MEMO):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def make_room(self) -> None:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()

    def drop(self) -> None:
        if self:
            self.clear()
            self.old = {}

    def __missing__(self, key: str) -> bytes:
        if len(key) > MEMO_LETTERS:
            return self.make(key)
        self.make_room()
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        self[key] = found
        return found


class BytePairs:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        letters = byte_letters()
        raw = {t: bytes(letters[c] for c in t) for t in spec["model"]["vocab"]}
        self.id_of = {raw[t]: i for t, i in spec["model"]["vocab"].items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.rank = {(raw[a], raw[b]): r for r, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.packed = {b: i.to_bytes(4, "little") for b, i in self.id_of.items()}
        bytes_of = {i: b for b, i in self.id_of.items()} | {i: t.encode() for t, i in self.special.items()}
        known = [bytes_of.get(i, b"") for i in range(max(bytes_of) + 1)]
        self.flat, self.sizes = np.frombuffer(b"".join(known), np.uint8), np.array([len(b) for b in known], np.int32)
        self.starts = (np.cumsum(self.sizes) - self.sizes).astype(np.int32)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pieces = Memo(self._piece)

    def merge(self, word: bytes) -> list[bytes]:
        parts = [word[k : k + 1] for k in range(len(word))]
        if len(parts) > SHORT:
            return self._merge_long(parts)
        get, none = self.rank.get, 1 << 60
        ranks = [get(p, none) for p in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == none:
                break
            k = ranks.index(low)
            parts[k] += parts.pop(k + 1)
            ranks.pop(k)
            if k:
                ranks[k - 1] = get((parts[k - 1], parts[k]), none)
            if k < len(ranks):
                ranks[k] = get((parts[k], parts[k + 1]), none)
        return parts

    def _merge_long(self, parts: list[bytes | None]) -> list[bytes]:
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k, k + 1, *p) for k, p in enumerate(zip(parts, parts[1:])) if (r := self.rank.get(p)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, j, a, b = heapq.heappop(heap)
            if parts[i] != a or after[i] != j or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := self.rank.get((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (r, x, y, parts[x], parts[y]))
        return [p for p in parts if p is not None]

    def _word(self, word: str) -> bytes:
        return b"".join(map(self.packed.__getitem__, self.merge(word.encode())))

    def _piece(self, piece: str) -> bytes:
        if piece[-1:] in (".", ",") and piece[-2:-1].isalpha():
            return self.pieces[piece[:-1]] + self._word(piece[-1])
        return b"".join(map(self._word, [piece] if piece.removeprefix(" ").isalpha() else PATTERN.findall(piece)))

    def encode_plain(self, text: str) -> bytes:
        if not evenly_spaced(text):
            return self._piece(text)
        # no token crosses from other characters to white space, and a blank before others belongs to their token
        return b"".join(map(self.pieces.__getitem__, text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; a special token's string in the text becomes that token."""
        if self.cut is None or not self.cut.search(text):
            return self.encode_plain(text)
        return b"".join(np.array([self.special[p]], "<u4").tobytes() if p in self.special else self.encode_plain(p) for p in self.cut.split(text) if p)

    def decode(self, ids: bytes) -> str:
        found = np.frombuffer(ids, "<u4")
        sizes = self.sizes[found]
        ends = np.cumsum(sizes, dtype=np.int32)
        where = np.repeat(self.starts[found] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)
        return self.flat[where].tobytes().decode("utf-8", "replace")


def _ranges(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each range, end to end."""
    ends = np.cumsum(sizes)
    return np.repeat(begin - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class LibraryPieces:
    """Whole columns of texts encoded by the tokenizers library, each distinct piece of a few megabytes once, with a memo across them.

    Texts are cut before blanks and around line feeds, where no token of a byte-level vocabulary crosses; texts with other white space
    or a special token's string go to the library whole. Words of long-known letters go to the library's model, which is what its
    splitting would hand it; all other pieces take the library's own way.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.letters = {b: c for c, b in byte_letters().items()}
        self.stops = {c: int.from_bytes(self._library(c), "little") for c in ".,"}
        self.line = self._library("\n")
        self.pieces = Memo(self._library)

    def _library(self, text: str) -> bytes:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def _lines(self, pieces: list[str]) -> Iterator[bytes]:
        """Of pieces without white space but for one blank in front: all as lines of one text, cut at the line feed's token."""
        for k in range(0, len(pieces), PIECES_AT_ONCE):
            found = self._library("\n".join(pieces[k : k + PIECES_AT_ONCE]))
            ends = (4 * np.flatnonzero(np.frombuffer(found, "<u4") == int.from_bytes(self.line, "little"))).tolist()
            yield from (found[a:b] for a, b in zip([0, *(e + 4 for e in ends)], [*ends, len(found)], strict=True))

    def _words(self, pieces: list[str]) -> Iterator[bytes]:
        """Of words of OLD_LETTERS, a blank in front or none: the library's model, as its own splitting keeps each whole."""
        tokenize, blank, ids, sizes = self.model.tokenize, self.letters[32], [], []
        for p in pieces:
            before = len(ids)
            ids += [t.id for t in tokenize(p.replace(" ", blank) if p.isascii() else p.encode().decode("latin-1").translate(self.letters))]
            sizes.append(len(ids) - before)
        raw, ends = np.array(ids, "<u4").tobytes(), (4 * np.cumsum(sizes, dtype=np.int64)).tolist()
        return (raw[a:b] for a, b in zip([0, *ends], ends))

    def _bare(self, pieces: pa.Array) -> list[bytes]:
        """Ids of distinct pieces, from the memo or the library."""
        self.pieces.make_room()
        names, word = pieces.to_numpy(zero_copy_only=False).tolist(), pc.match_substring_regex(pieces, f"^ ?[{OLD_LETTERS}]+$").to_numpy(zero_copy_only=False).tolist()
        found, old, words, lines = list(map(self.pieces.get, names)), self.pieces.old, [], []
        for k in [k for k, v in enumerate(found) if v is None]:
            p = names[k]
            if (v := old.get(p)) is not None:
                self.pieces[p] = found[k] = v
            elif word[k]:
                words.append(k)
            elif p in ("", "\n"):
                found[k] = self._library(p)
            else:
                lines.append(k)
        for places, make in ((words, self._words), (lines, self._lines)):
            for k, v in zip(places, make([names[k] for k in places]), strict=True):
                found[k] = v
                if len(names[k]) <= MEMO_LETTERS:
                    self.pieces[names[k]] = v
        return found

    def _all(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces end to end, where each starts, and how many it has. A full stop or comma after a letter is a token by itself."""
        stop = pc.match_substring_regex(pieces, f"[{OLD_LETTERS}][.,]$")
        bare = pc.if_else(stop, pc.utf8_slice_codeunits(pieces, 0, -1), pieces).dictionary_encode()
        stop, comma, which = (x.to_numpy(zero_copy_only=False) for x in (stop, pc.ends_with(pieces, ","), bare.indices))
        found = self._bare(bare.dictionary)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, sizes_each = np.frombuffer(b"".join(found), "<u4"), sizes[which] + stop
        ends = np.cumsum(sizes_each)
        ids = np.append(flat, np.uint32(0))[_ranges((np.cumsum(sizes) - sizes)[which], sizes_each)]  # where a stop goes stands any id until the next line
        ids[ends[stop] - 1] = np.where(comma[stop], self.stops[","], self.stops["."])
        return ids, ends - sizes_each, sizes_each

    def encode_column(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For runs of rows of about COLUMN_BYTES: first row, row after the last, all their ids, and each row's offsets in them. Null is empty."""
        texts = texts.fill_null("")
        lengths = pc.cast(pc.binary_length(texts), pa.int64()).to_numpy(zero_copy_only=False)
        for i, j in slices(np.concatenate([[0], np.cumsum(lengths)]), COLUMN_BYTES):
            some = texts.slice(i, j - i)
            odd = pc.match_substring_regex(some, ODD_SPACE)
            for s in self.special:
                odd = pc.or_(odd, pc.match_substring(some, s))
            odd = odd.to_numpy(zero_copy_only=False)
            marked = pc.replace_substring(pc.replace_substring(pc.if_else(pa.array(odd), "", some), " ", "\0 "), "\n", "\0\n\0")
            cut = pc.split_pattern(marked, "\0")
            coded = cut.flatten().dictionary_encode()
            which, at = coded.indices.to_numpy(), cut.offsets.to_numpy().astype(np.int64)
            flat, begin, sizes = self._all(coded.dictionary)
            each = sizes[which]
            ids, offsets = flat[_ranges(begin[which], each)], np.concatenate([[0], np.cumsum(each)])[at - at[0]]
            if odd.any():
                rows = [ids[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
                for k in np.flatnonzero(odd):
                    rows[k] = np.frombuffer(self._library(some[int(k)].as_py()), "<u4")
                ids, offsets = np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])
            yield i, j, ids, offsets


@lru_cache(4)
def encoder(path: str, kind: type = BytePairs) -> BytePairs | LibraryPieces:
    """One encoder a Python worker and file."""
    return kind(path)


def forget_encoders() -> None:
    """For tasks of later stages: free what this Python worker keeps for encoding."""
    encoder.cache_clear()


def _round_trip(path: str, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        try:
            for batch in batches:
                n, ids_sha, text_sha, ids = [], [], [], []
                for text in batch.column("text"):
                    found = bpe.encode(text.as_py() or "")
                    n.append(len(found) // 4)
                    ids_sha.append(hashlib.sha256(found).hexdigest())
                    text_sha.append(hashlib.sha256(bpe.decode(found).encode()).hexdigest())
                    if keep_ids:
                        ids.append(np.frombuffer(found, "<u4"))
                columns = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}
                if keep_ids:
                    columns["ids"] = pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)
        finally:
            bpe.pieces.drop()

    return run


def bpe_round_trip(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text), in place and without a shuffle: doc_id, n_tokens, ids_sha256 (of the
    ids as little-endian unsigned 32-bit integers), decoded_sha256 (of the decoded text) and, if asked for, ids.

    Null texts count as empty: no ids. A text holding a special token's string gives that token's id.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return with_text(docs).mapInArrow(_round_trip(path, keep_ids), schema)
