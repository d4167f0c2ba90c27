"""Shared by the text operators: the input tables, folds, Arrow batches and split-then-encode tokens.

A text is cut into pieces that a tokenizer treats independently of each other, every distinct piece of a
batch is encoded once, and the ids are gathered back. The ids are those of the whole text.
"""

from __future__ import annotations

import ctypes
import gc
import os
import re
from array import array
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task holds as pieces at once; a longer text is a batch of its own.
BATCH_BYTES = 8 << 20
#: Distinct pieces whose ids a worker remembers between batches: of those it met again, and of the others.
CACHE_PIECES = 300_000

# Code points that any of the tokenizers or str.isspace() counts as white space.
_SPACES = r"\t-\r \x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_CUT = "\x01"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(key: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo `folds`; NULL counts as an empty id."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(folds)).cast("int")


def slices(batch: pa.RecordBatch, column: str = "text", most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about `most` bytes of text each, one row at least."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, stop - at)
        at = stop


@contextmanager
def small_batches(spark: SparkSession, most: int = 4 << 20, rows: int | None = None) -> Iterator[None]:
    """Jobs that run inside hand their Python workers batches of about `most` bytes, in place of the session's 64 MB.

    With `rows` the JVM also reads so few rows of Parquet at a time: for tables whose rows hold megabytes.
    """
    wanted = {"spark.sql.execution.arrow.maxBytesPerBatch": str(most)}
    if rows:
        wanted["spark.sql.parquet.columnarReaderBatchSize"] = str(rows)
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _trim = None


def give_back() -> None:
    """Returns memory that this worker has freed to the machine: executors share it with the JVM."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def sparing(run: Run) -> Run:
    """The same function of a partition's batches, without looking for cycles (there are none, and the many small
    lists of tokens make that a tenth of the time), and with freed memory returned when it ends."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        try:
            yield from run(batches)
        finally:
            gc.enable()
            give_back()

    return wrapped


def whole(texts: pa.Array) -> pa.Array:
    """Texts as large strings, NULL as empty: offsets of a batch may pass 2 GB.

    A part of a batch gets offsets and bytes of its own: some kernels (`ascii_lower`) take an array
    without an offset for one that begins with its buffer, and give other texts.
    """
    out = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(out):
        return out
    _, offsets, data = out.buffers()
    ends = np.frombuffer(offsets, np.int64)[out.offset:out.offset + len(out) + 1]
    if data is None or (out.offset == 0 and ends[0] == 0):
        return out
    own = data.slice(int(ends[0]), int(ends[-1] - ends[0]))
    return pa.LargeStringArray.from_buffers(len(out), pa.py_buffer(ends - ends[0]), own)


def word_pieces(texts: pa.Array) -> pa.Array:
    """For tokenizers that drop white space: runs without ASCII white space, which no token crosses."""
    return pc.ascii_split_whitespace(texts)


def spaced_pieces(texts: pa.Array) -> pa.Array:
    """For tokenizers that keep white space and join at most one space to the word after it.

    A space or line end after another character starts a piece: a token never reaches over such a
    place. Texts with white space before a space or line end (or with the cut mark) stay one piece.
    """
    marked = pc.replace_substring(pc.replace_substring(texts, " ", _CUT + " "), "\n", _CUT + "\n")
    odd = pc.match_substring_regex(texts, f"[{_SPACES}][ \n]|{_CUT}")
    pieces = pc.split_pattern(marked, _CUT)
    if not pc.any(odd).as_py():
        return pieces
    own = pa.array([[t] for t in texts.to_pylist()], pieces.type)
    return pc.if_else(odd, own, pieces)


class PieceEncoder:
    """Encodes texts piece by piece; `encode` maps a list of new pieces to the bytes of their tokens.

    A token is one number of `kind`, or `width` of them. Tokens are kept between batches, up to a bound
    each for pieces that were met again and for those met once, which are dropped the sooner.
    """

    def __init__(self, split: Callable[[pa.Array], pa.Array], encode: Callable[[list[str]], list[bytes]],
                 kind: str = "<u4", width: int = 1):
        self.split, self.encode, self.kind, self.width = split, encode, kind, width
        self.known: dict[str, bytes] = {}
        self.recent: dict[str, bytes] = {}

    def pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Offsets of each text into the pieces, the index of each piece, and the distinct pieces."""
        lists = self.split(texts)
        flat = lists.flatten().dictionary_encode()
        lengths = np.asarray(pc.list_value_length(lists), dtype=np.int64)
        return np.concatenate([[0], np.cumsum(lengths)]), np.asarray(flat.indices), flat.dictionary.to_pylist()

    def parts(self, distinct: list[str], index: np.ndarray) -> list[bytes]:
        """Tokens of every distinct piece."""
        known, recent = self.known, self.recent
        new = [p for p in distinct if p not in known and p not in recent]
        made = dict(zip(new, self.encode(new)))
        met = {p: recent.pop(p) for p in distinct if p in recent}
        out = [known[p] if p in known else met[p] if p in met else made[p] for p in distinct]
        again = np.bincount(index, minlength=len(distinct)) > 1
        met.update((p, made.pop(p)) for p, more in zip(distinct, again.tolist()) if more and p in made)
        self.known = met if len(known) + len(met) > CACHE_PIECES else known | met
        self.recent = made if len(recent) + len(made) > CACHE_PIECES else recent | made
        return out

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of each text into the ids, and all ids."""
        starts, index, distinct = self.pieces(texts)
        ends, ids = self.gather(self.parts(distinct, index), index)
        return ends[starts], ids

    def gather(self, parts: list[bytes], index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of each piece into the tokens, and all tokens, from those of the distinct pieces."""
        pool = np.frombuffer(b"".join(parts), self.kind)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // (pool.itemsize * self.width)
        if self.width > 1:
            pool = pool.reshape(-1, self.width)
        first = np.cumsum(sizes) - sizes
        each = sizes[index]
        ends = np.concatenate([[0], np.cumsum(each)])
        # Place of every token in the pool: the start of its piece plus its place in the piece.
        places = np.repeat(first[index] - ends[:-1], each) + np.arange(ends[-1])
        return ends, pool[places]


_encoders: dict[tuple, PieceEncoder] = {}

# Latin letters that normal forms leave alone and that have one lower-case letter each.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
_COMMON = re.compile(f"[ \n]?[!-~{_LATIN}]+")
_WORDS = re.compile(f"{_SHORT}|[{_LATIN}]+|[0-9]|[^\\s0-9{_LATIN}]+")
_SPACED = re.compile(f"{_SHORT}| ?[{_LATIN}]+| ?[0-9]+| ?[^\\s0-9{_LATIN}]+|\\s+")


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself where it is printable
    Latin-1, else the next free code point from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


_STAND = dict(enumerate(byte_symbols()))


def word_splitter(path: str, plain: bool = False) -> Callable[[str], list[str] | None]:
    """From a piece to the words that the file's merges work on, as symbols of bytes.

    Pieces of ASCII and common Latin letters are split by the file's pattern as it reads for them,
    others by the library's own normal form and splitting. None where a special string may stand in
    the piece: the whole library must take that. With `plain` the caller has taken special strings out
    and no piece gives None.
    """
    from tokenizers import Tokenizer

    tokenizer, split = Tokenizer.from_file(path), splitter(path)
    normal, before = tokenizer.normalizer, tokenizer.pre_tokenizer
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    mark = os.path.commonprefix(special) if special and not plain else None
    pattern = {word_pieces: _WORDS, spaced_pieces: _SPACED}.get(split)
    lower, spaced = split is word_pieces, split is spaced_pieces
    space = _STAND[0x20]

    def words(piece: str) -> list[str] | None:
        # The most frequent kind first: letters alone, after a space where that is kept.
        if spaced and piece.startswith(" "):
            body = piece[1:]
            if body.isascii() and body.isalpha():
                return [space + body]
        elif pattern and piece.isascii() and piece.isalpha():
            return [piece.lower() if lower else piece]
        if mark is not None and mark in piece:
            return None
        if pattern and _COMMON.fullmatch(piece):
            found = pattern.findall(piece.lower() if lower else piece)
            if lower and piece.isascii():
                return found
            return [w.encode().decode("latin-1").translate(_STAND) for w in found]
        return [w for w, _ in before.pre_tokenize_str(normal.normalize_str(piece) if normal else piece)]

    return words


def library_encoder(path: str) -> PieceEncoder:
    """The tokenizers library behind PieceEncoder, one per worker and file; special strings as the library takes them.

    Distinct pieces are short, so most of a full call would go to its frame: the library's steps
    (normal form, splitting, merges) are called one by one.
    """
    key = ("library", path)
    if key not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core only
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        words, merge = word_splitter(path), tokenizer.model.tokenize

        def encode(pieces: list[str]) -> list[bytes]:
            merged: dict[str, bytes] = {}

            def of_word(w: str) -> bytes:
                own = merged.get(w)
                if own is None:
                    own = merged[w] = array("I", [t.id for t in merge(w)]).tobytes()
                return own

            out = []
            for piece in pieces:
                parts = words(piece)
                if parts is None:
                    out.append(array("I", tokenizer.encode(piece, add_special_tokens=False).ids).tobytes())
                elif len(parts) == 1:
                    out.append(of_word(parts[0]))
                else:
                    out.append(b"".join(map(of_word, parts)))
            return out

        _encoders[key] = PieceEncoder(splitter(path), encode)
    return _encoders[key]


def span_encoder(path: str) -> PieceEncoder:
    """Like library_encoder, with (id, first character, character after the last) of each token in its piece.

    Pieces cover the whole text, so that a token's place in the text follows from its piece's.
    """
    key = ("spans", path)
    if key not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        def encode(pieces: list[str]) -> list[np.ndarray]:
            out = []
            for at in range(0, len(pieces), 10_000):
                for e in tokenizer.encode_batch(pieces[at:at + 10_000], add_special_tokens=False):
                    spans = np.array(e.offsets, "<u4").reshape(-1, 2)
                    out.append(np.column_stack([np.array(e.ids, "<u4"), spans]).tobytes())
            return out

        split = splitter(path)
        cover = split if split is spaced_pieces else single_pieces
        _encoders[key] = PieceEncoder(cover, encode, width=3)
    return _encoders[key]


def single_pieces(texts: pa.Array) -> pa.Array:
    """For any tokenizer: every text is one piece."""
    return pa.array([[t] for t in texts.to_pylist()], pa.large_list(pa.large_string()))


def splitter(path: str) -> Callable[[pa.Array], pa.Array]:
    """Only the two kinds of files whose pieces are known to be independent; else a text is one piece."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    before, normal = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    added = [t["content"] for t in spec.get("added_tokens", [])]
    plain = not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", []))
    plain = plain and not any(re.search(r"\s", t) for t in added)
    if plain and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and normal is None:
        return spaced_pieces
    steps = [s.get("type") for s in before.get("pretokenizers", [])]
    kept = [s.get("type") for s in (normal or {}).get("normalizers", [])]
    if plain and steps == ["Split", "ByteLevel"] and kept == ["NFC", "Replace", "Lowercase"]:
        first = before["pretokenizers"][0]
        if first.get("behavior") == "Removed" and first.get("invert") and r"[^\s\p{L}\p{N}]+" in first["pattern"].get("Regex", ""):
            return word_pieces
    return single_pieces
