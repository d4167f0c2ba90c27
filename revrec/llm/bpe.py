"""BPE encoding and decoding with a pair occurrence index.

All distinct words of a batch lie in one array of symbols. The index maps every merge rank to the
positions where its pair stands. Active ranks are taken in ascending order from a heap; all positions of
a rank are merged at once, and the pairs that this makes are added to the lists of their own ranks.
Each word sees its merges in the same order as when it is encoded alone.

Rules: NULL text counts as empty and has no ids; special strings in a text become their own ids, as the
library does; extra columns are ignored; repeated rows give repeated rows.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revrec.llm.texts import PieceEncoder, byte_symbols, documents, slices, whole, word_pieces, word_splitter

ENCODED = "doc_id bigint, ids array<int>"
DECODED = "doc_id bigint, ids array<int>, decoded string"


class PairIndex:
    """Merges of a vocabulary, applied to many words at once."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.left = np.array([self.vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([self.vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([self.vocab[a + b] for a, b in pairs], np.int64)
        self.width = max(self.vocab.values()) + 1
        keys = self.left * self.width + self.right
        # A pair listed twice has its last rank, as in a map that is filled in order.
        last = {k: r for r, k in enumerate(keys.tolist())}
        self.keys = np.array(sorted(last), np.int64)
        self.ranks = np.array([last[k] for k in self.keys.tolist()], np.int64)
        # Ranks whose product stands in an earlier merge: their places are merged one per word at a time,
        # so that a lower rank that appears is applied first.
        least = np.full(self.width, len(pairs))
        for side in (self.left, self.right):
            np.minimum.at(least, side[self.ranks], self.ranks)
        self.early = set(np.flatnonzero(least[self.made] < np.arange(len(pairs))).tolist())
        stand = byte_symbols()
        self.first = np.array([self.vocab[c] for c in stand], np.int64)
        self.final = np.array([self.vocab[c + self.suffix] for c in stand], np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, or -1."""
        want = a * self.width + b
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where((a >= 0) & (b >= 0) & (self.keys[at] == want), self.ranks[at], -1)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and all ids. Empty words have none."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        n, ends = len(raw), np.cumsum(sizes)
        last = np.zeros(n, bool)
        last[ends[sizes > 0] - 1] = True
        # One place more, as the neighbour of the outer symbols: symbol -1 is in no pair.
        symbol = np.append(np.where(last, self.final[raw], self.first[raw]), -1)
        nxt = np.append(np.where(last, n, np.arange(1, n + 1)), n)
        prv = np.append(np.arange(-1, n - 1), n)
        prv[np.concatenate([ends - sizes, [n]])[np.append(sizes > 0, True)]] = n
        word = np.repeat(np.arange(len(words)), sizes)
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(places: np.ndarray) -> None:
            ranks = self.rank(symbol[places], symbol[nxt[places]])
            places, ranks = places[ranks >= 0], ranks[ranks >= 0]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for r, part in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(places, cuts)):
                if r not in index:
                    index[r] = []
                    heapq.heappush(heap, r)
                index[r].append(part)

        add(np.arange(n))
        while heap:
            r = heapq.heappop(heap)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            at = at[(symbol[at] == self.left[r]) & (symbol[nxt[at]] == self.right[r])]
            if not len(at):
                continue
            again = at[:0]
            if r in self.early:
                ahead = np.append(True, word[at[1:]] != word[at[:-1]])
                at, again = at[ahead], at[~ahead]
            elif self.left[r] == self.right[r] and len(at) > 1:
                # In a run of equal symbols every second pair falls away, from the left.
                overlaps = np.append(False, nxt[at[:-1]] == at[1:])
                starts = np.flatnonzero(~overlaps)
                run = np.repeat(starts, np.diff(np.append(starts, len(at))))
                at = at[(np.arange(len(at)) - run) % 2 == 0]
            gone = nxt[at]
            after = nxt[gone]
            symbol[at] = self.made[r]
            symbol[gone] = -1
            nxt[at] = after
            inner = after < n
            prv[after[inner]] = at[inner]
            before = prv[at]
            near = np.concatenate([before[before < n], at])
            add(np.unique(near) if len(near) > 1 else near)
            if len(again):
                if r not in index:
                    index[r] = []
                    heapq.heappush(heap, r)
                index[r].append(again)
        kept = symbol[:n] >= 0
        return np.bincount(word[kept], minlength=len(words)), symbol[:n][kept]


class Codec:
    """A byte-level BPE file with word ends: normal form, words, pair index; and the way back."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.index = PairIndex(spec)
        self.split = word_splitter(path, plain=True)  # the library's normal form and words; the merges are ours
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        cut = "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.specials = re.compile(f"({cut})") if cut else None
        names = {i: t for t, i in self.index.vocab.items()} | {i: t for t, i in self.special.items()}
        self.token = [names.get(i, "") for i in range(max(names) + 1)]
        self.byte = {c: b for b, c in enumerate(byte_symbols())}
        self.encoder = PieceEncoder(word_pieces, self.encode_pieces)

    def words(self, text: str) -> list[bytes]:
        """The words that the merges work on, as bytes; no special string stands in `text`."""
        byte = self.byte
        return [w.encode() if w.isascii() else bytes(byte[c] for c in w) for w in self.split(text)]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece: its words go to one index for the whole batch, each distinct word once."""
        order: dict[bytes, int] = {}
        plans: list[list[int]] = []  # per piece: the number of a word, or -1 - id for a special string
        for piece in pieces:
            plan = []
            for part in self.specials.split(piece) if self.specials and "<" in piece else (piece,):
                if part in self.special:
                    plan.append(-1 - self.special[part])
                elif part:
                    plan += [order.setdefault(w, len(order)) for w in self.words(part)]
            plans.append(plan)
        sizes, ids = self.index.encode(list(order))
        raw, ends = ids.astype("<u4").tobytes(), 4 * np.cumsum(sizes)
        starts = (ends - 4 * sizes).tolist()
        ends = ends.tolist()

        def of(k: int) -> bytes:
            return raw[starts[k]:ends[k]] if k >= 0 else (-1 - k).to_bytes(4, "little")

        return [of(p[0]) if len(p) == 1 else b"".join(map(of, p)) for p in plans]

    def decode(self, ids: list[int]) -> str:
        """Tokens with one space between them: files without a decoder of their own are joined like this."""
        return " ".join([self.token[i] for i in ids])


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every whole text; one row per row of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path).encoder
        for batch in batches:
            for part in slices(batch):
                offsets, ids = coder.ids(whole(part.column("text")))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "ids"])

    return _slim(docs).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds `decoded`, the text of `ids`, special tokens included; NULL ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = codec(path)
        for batch in batches:
            ids = batch.column("ids")
            for at in range(0, len(ids), 256):
                part = batch.slice(at, 256)
                texts = [back.decode(x or []) for x in part.column("ids").to_pylist()]
                columns = [part.column("doc_id"), part.column("ids"), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, DECODED)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded) of every whole text, both ways in one task: half the workers and transfers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for part in slices(batch):
                offsets, ids = own.encoder.ids(whole(part.column("text")))
                for at in range(0, len(part), 256):
                    ends = offsets[at:at + 257]
                    few = ids[ends[0]:ends[-1]]
                    listed, cuts = few.tolist(), (ends - ends[0]).tolist()
                    texts = [own.decode(listed[a:b]) for a, b in zip(cuts, cuts[1:])]
                    lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(few.astype(np.int32)))
                    columns = [part.column("doc_id").slice(at, 256), lists, pa.array(texts, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    return _slim(docs).mapInArrow(run, DECODED)


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded texts of all documents."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    done = round_trip(documents(spark, sf_dir), path)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
