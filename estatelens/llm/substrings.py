"""Removal of word windows that an earlier document holds, by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words. Its minimiser is the least of its word pairs in a fixed hashed order; consecutive
windows that share one form a super-k-mer and travel as one packed string of words to the minimiser's bucket, so a text
is shuffled about three times over, compressed, instead of thirteen. Equal windows have equal minimisers and meet in one
bucket, where sorting them counts them exactly: windows are sorted by hash, and equal hashes are compared word by word.

Skew. Tasks take texts in blocks of about ``BLOCK_CHARS`` characters. Equal super-k-mers of a block are folded there: all but
those of the smallest document are known to be removed and do not travel, so a passage that a third of all documents
share reaches its bucket once a block. Word pairs that are frequent in a sample come last in the order, so they are
minimisers only of windows with nothing rarer; such windows go to buckets of their own, by the hash of the whole window.
The sample grows with the number of buckets and steers the traffic only: any sample gives the same rows.

A bucket returns the ranges of words to remove. They are joined to their documents by id and text hash, and the kept
words are written from the whole text.

Edge cases: a null text has no words; rows without doc_id keep all words and remove none; rows that repeat a doc_id are
judged each by its own text and do not remove each other's words; texts of fewer words than a window stay whole; a window
that only repeats within its document stays; an empty table gives an empty result; extra columns are kept by ``cleaned``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import ship, staged

ship(__name__)

WINDOW = 13
BLOCK_CHARS = 6_000_000
COMPARED = 500_000
BUCKET_CHARS = 5_000_000  # characters of the corpus per bucket
SAMPLE_DOCS = 4000  # documents looked at for frequent word pairs, at least
SAMPLE_PER_BUCKET = 4
MAX_FREQUENT = 1_000_000  # 8 MB sent to each task at most

ODD1, ODD2, ODD3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
TOP = np.uint64(1 << 63)

SPLIT = "bucket long, words binary, owners binary, id long, digest int, first int, after int"
RANGES = "id long, digest int, first int, after int"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * ODD2
    return x ^ x >> np.uint64(29)


def _split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """All words of some texts as ids, the number of words of each text, and the words by id."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    flat = lists.flatten()
    full = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    counts = np.diff(np.r_[0, np.cumsum(full)][offsets])
    words = flat.filter(pa.array(full)).cast(pa.large_binary()).dictionary_encode()
    return words.indices.to_numpy(zero_copy_only=False), counts, words.dictionary


def _hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words.to_pylist()), np.uint64, len(words))


def _pairs(h: np.ndarray) -> np.ndarray:
    """A hash of each word and the next."""
    return _mixed(h[:-1] * ODD1 + h[1:] * ODD3)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive values."""
    got, done = x, 1
    while 2 * done <= width:
        got, done = np.minimum(got[:-done], got[done:]), 2 * done
    more = width - done
    return np.minimum(got[:len(got) - more], got[more:]) if more else got


def _rolling(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums and inverse powers such that (sums[e] - sums[s]) * inverse[s] is a hash of words s to e - 1."""
    n = len(h) + 1
    inverse_of_odd1 = np.uint64(pow(int(ODD1), -1, 1 << 64))
    power = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, ODD1)], dtype=np.uint64)
    inverse = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, inverse_of_odd1)], dtype=np.uint64)
    return np.r_[np.uint64(0), np.cumsum(h * power[:-1], dtype=np.uint64)], inverse


def _equal_ranges(ids: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the words from a[i] equal those from b[i], over length[i] words each; some millions of words at a time."""
    out = np.zeros(len(a), bool)
    total = np.cumsum(length)
    at = 0
    while at < len(a):
        upto = max(at + 1, int(np.searchsorted(total, total[at] + COMPARED)))
        n = length[at:upto]
        starts = np.cumsum(n) - n
        step = np.arange(int(n.sum())) - np.repeat(starts, n)
        out[at:upto] = np.logical_and.reduceat(ids[np.repeat(a[at:upto], n) + step] == ids[np.repeat(b[at:upto], n) + step], starts)
        at = upto
    return out


def _classes(ids: np.ndarray, start: np.ndarray, length: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """For each range of words the index of the first of the ranges equal to it: sorted by hash, compared word by word."""
    order = np.argsort(hashed, kind="stable")
    first = np.r_[True, hashed[order][1:] != hashed[order][:-1]][:len(order)]
    head = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    out = np.empty(len(start), np.int64)
    out[order] = head
    other = np.flatnonzero(out != np.arange(len(out)))
    same = length[other] == length[out[other]]
    same[same] = _equal_ranges(ids, start[other[same]], start[out[other[same]]], length[other[same]])
    seen: dict[bytes, int] = {}
    for i in other[~same].tolist():  # different words under one hash
        out[i] = seen.setdefault(ids[start[i]:start[i] + length[i]].tobytes(), i)
    return out


def _spans(valid: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of consecutive valid windows with one value."""
    if not len(valid):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.r_[True, (value[1:] != value[:-1]) | (valid[1:] != valid[:-1])]
    starts = np.flatnonzero(cut)
    ends = np.r_[starts[1:], len(valid)]
    return starts[valid[starts]], ends[valid[starts]]


def _packed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 3).compress(raw, asbytes=True)


def _unpacked(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)


def _ranges(ids, digests, first, after) -> pa.RecordBatch:
    arrays = [pa.array(np.asarray(v, t)) for v, t in ((ids, np.int64), (digests, np.int32), (first, np.int32), (after, np.int32))]
    return pa.RecordBatch.from_arrays(arrays, ["id", "digest", "first", "after"])


def _strings(words: pa.Array, ids: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    """The words of each range joined by blanks."""
    before = np.cumsum(length) - length
    index = np.arange(int(length.sum())) + np.repeat(start - before, length)
    lists = pa.LargeListArray.from_arrays(pa.array(np.r_[before, length.sum()].astype(np.int64)), words.take(pa.array(ids[index])))
    return pc.binary_join(lists, pa.scalar(b" ", pa.large_binary()))


class Splitter:
    """Super-k-mers of blocks of documents, dealt to buckets."""

    def __init__(self, buckets: int, frequent: np.ndarray, window: int, block_chars: int):
        self.buckets, self.frequent, self.window, self.block_chars = buckets, np.sort(frequent), window, block_chars

    def block(self, doc_ids: np.ndarray, digests: np.ndarray, texts: pa.Array) -> tuple[list[tuple[int, bytes, bytes]], pa.RecordBatch]:
        """Rows for buckets, and the removals that the block alone shows."""
        w = self.window
        ids, counts, words = _split(texts)
        n = len(ids)
        if n < w:
            return [], _ranges([], [], [], [])
        h = _hashes(words)[ids]
        order = _pairs(h) >> np.uint64(1)
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, order), len(self.frequent) - 1)
            order = np.where(self.frequent[at] == order, order | TOP, order)
        least = _sliding_min(order, w - 1)
        doc = np.repeat(np.arange(len(counts)), counts)
        valid = doc[:len(least)] == doc[w - 1:]
        sums, inverse = _rolling(h)
        whole = (sums[w:] - sums[:-w]) * inverse[:len(least)]
        # a window of frequent pairs alone is a run of its own, named by all its words
        least = np.where(least >= TOP, _mixed(whole) | TOP, least)
        s, e = _spans(valid, least)
        length = e - s + w - 1
        same = _classes(ids, s, length, (sums[s + length] - sums[s]) * inverse[s])
        owner, digest = doc_ids[doc[s]], digests[doc[s]]
        begin = s - (np.cumsum(counts) - counts)[doc[s]]
        least_owner = np.full(len(s), np.iinfo(np.int64).max)
        np.minimum.at(least_owner, same, owner)
        later = np.flatnonzero(owner > least_owner[same])
        # ranges that touch are one
        new = np.r_[True, (doc[s[later]][1:] != doc[s[later]][:-1]) | (begin[later][1:] > (begin + length)[later][:-1])][:len(later)]
        last = np.r_[new[1:], True][:len(later)]
        local = _ranges(owner[later[new]], digest[later[new]], begin[later[new]], (begin + length)[later[last]])

        # one packed string per class, and its owners of the smallest id
        stay = np.flatnonzero(owner == least_owner[same])
        bucket = (_mixed(least[s[stay]]) % np.uint64(self.buckets)).astype(np.int64)
        sort = np.lexsort((same[stay], bucket))
        stay, bucket = stay[sort], bucket[sort]
        new = np.r_[True, same[stay][1:] != same[stay][:-1]]
        strings = _strings(words, ids, s[stay[new]], length[stay[new]])
        label = np.cumsum(new) - 1
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        owners = np.stack([label, owner[stay], digest[stay], begin[stay]]).astype("<i8")
        rows = []
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(stay)]):
            own = owners[:, a:b].copy()
            lines = strings.slice(own[0, 0], own[0, -1] - own[0, 0] + 1).to_pylist()
            own[0] -= own[0, 0]
            rows.append((int(bucket[a]), _packed(b"\n".join(lines) + b"\n"), _packed(own.tobytes())))
        return rows, local

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            # slices of a batch, so that a block does not outgrow its bound by long texts
            lengths = np.r_[0, np.cumsum(pc.binary_length(batch.column(2)).to_numpy())]
            at = 0
            while at < batch.num_rows:
                upto = max(at + 1, int(np.searchsorted(lengths, lengths[at] + self.block_chars, "right")) - 1)
                more = int(lengths[upto] - lengths[at])
                if held and size + more > self.block_chars:
                    yield from self._flushed(held)
                    held, size = [], 0
                held.append(batch.slice(at, upto - at))
                size += more
                at = upto
        if held:
            yield from self._flushed(held)

    def _flushed(self, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        doc_ids, digests = table.column(0).to_numpy(), table.column(1).to_numpy()
        _, once = np.unique(np.stack([doc_ids, digests.astype(np.int64)]), axis=1, return_index=True)  # repeated rows
        once.sort()
        texts = pa.chunked_array([c.cast(pa.large_string()) for c in table.column(2).chunks]).combine_chunks().take(pa.array(once))
        rows, local = self.block(doc_ids[once], digests[once], texts)
        none = lambda n, *types: [pa.nulls(n, t) for t in types]
        names = ["bucket", "words", "owners", "id", "digest", "first", "after"]
        for row in rows:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int64(), pa.binary(), pa.binary()))] + none(1, pa.int64(), pa.int32(), pa.int32(), pa.int32()), names)
        if local.num_rows:
            spread = (_mixed(local.column(0).to_numpy().astype(np.uint64)) % np.uint64(self.buckets)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(spread), *none(local.num_rows, pa.binary(), pa.binary()), *local.columns], names)


def bucket_removals(blocks: list[tuple[bytes, bytes]], window: int = WINDOW) -> pa.RecordBatch:
    """The ranges of words to remove that the windows of one bucket show."""
    texts, owners, base = [], [], 0
    for words, own in blocks:
        lines = _unpacked(words)
        texts.append(lines)
        o = np.frombuffer(_unpacked(own), "<i8").reshape(4, -1).copy()
        o[0] += base
        base += lines.count(b"\n")
        owners.append(o)
    strings = pa.array(b"".join(texts).split(b"\n")[:-1], pa.large_binary()).cast(pa.large_string())
    del texts
    ids, counts, words = _split(strings)
    del strings
    sums, inverse = _rolling(np.random.default_rng(7).integers(0, 1 << 63, len(words), dtype=np.uint64)[ids])
    per = counts - window + 1
    string = np.repeat(np.arange(len(counts)), per)
    step = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
    at = (np.cumsum(counts) - counts)[string] + step
    same = _classes(ids, at, np.full(len(at), window), (sums[at + window] - sums[at]) * inverse[at])

    label, owner, digest, begin = np.concatenate(owners, axis=1)
    of_string = np.full(len(counts), np.iinfo(np.int64).max)
    np.minimum.at(of_string, label, owner)
    least = np.full(len(at), np.iinfo(np.int64).max)
    np.minimum.at(least, same, of_string[string])
    low = least[same] < of_string[string]  # the owners of a string all have one id
    run, run_end = _spans(low, string)
    by_string = np.argsort(label, kind="stable")
    lo, hi = (np.searchsorted(label[by_string], string[run] + k) for k in (0, 1))
    times = hi - lo
    pick = by_string[np.repeat(lo, times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)]
    return _ranges(owner[pick], digest[pick], begin[pick] + np.repeat(step[run], times), begin[pick] + np.repeat(step[run_end - 1] + window, times))


def _frequent_pairs(docs: DataFrame, buckets: int, n_docs: int) -> np.ndarray:
    """Hashes of word pairs whose share of a sample's pairs is more than an eighth of a bucket's share."""
    want = max(SAMPLE_DOCS, SAMPLE_PER_BUCKET * buckets)
    keep = F.lit(True) if n_docs <= want else F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) < (1 << 30) * want // n_docs

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts, words = _split(batch.column(0))
            if len(ids) > 1:
                doc = np.repeat(np.arange(len(counts)), counts)
                value, times = np.unique((_pairs(_hashes(words)[ids]) >> np.uint64(1))[doc[:-1] == doc[1:]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value.astype(np.int64)), pa.array(times.astype(np.int64))], ["pair", "n"])

    counted = staged(docs.where(keep).select("text").mapInArrow(pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "substring-pairs")
    total = counted.agg(F.sum("n")).first()[0] or 0
    # by its share of the total the list has at most MAX_FREQUENT entries
    found = counted.where(F.col("n") * min(8 * buckets, MAX_FREQUENT) > total).select("pair").toArrow()
    return found["pair"].to_numpy().astype(np.uint64)


def removals(documents: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, bucket_chars: int = BUCKET_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, digest, first, after): ranges of words, counted from 0, covered by windows that a smaller id's text holds."""
    docs = documents.where(F.col(id_col).isNotNull() & F.col(text).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.hash(text).alias("digest"), F.col(text).alias("text"))
    size = docs.agg(F.sum(F.length("text")).alias("chars"), F.count(F.lit(1)).alias("n")).first()
    buckets = max(8, -(-(size["chars"] or 0) // bucket_chars))
    splitter = Splitter(buckets, _frequent_pairs(docs, buckets, size["n"]), window, block_chars)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from splitter(batches)

    def bucket(rows: pa.Table) -> pa.Table:
        mine = pc.is_valid(rows["words"])
        blocks = rows.filter(mine)
        known = rows.filter(pc.invert(mine)).select(["id", "digest", "first", "after"])
        if not blocks.num_rows:
            return known
        found = bucket_removals(list(zip(blocks["words"].to_pylist(), blocks["owners"].to_pylist())), window)
        return pa.concat_tables([known.cast(found.schema), pa.Table.from_batches([found])])

    return docs.mapInArrow(split, SPLIT).groupBy("bucket").applyInArrow(bucket, RANGES)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, text, ranges) to (row, n_words, n_removed, kept text)."""
    for batch in batches:
        total, gone, clean = [], [], []
        for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            words = (text or "").encode().split()
            total.append(len(words))
            if ranges:
                keep = np.ones(len(words), bool)
                for r in ranges:
                    keep[r["first"]:r["after"]] = False
                words = list(compress(words, keep.tolist()))
            gone.append(total[-1] - len(words))
            clean.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(clean, pa.string())], ["row", "n_words", "n_removed", "kept_text"])


def cleaned(documents: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, bucket_chars: int = BUCKET_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``row`` (all columns but the text), n_words, n_removed and kept_text: the words that stay, joined by blanks."""
    cuts = removals(documents, id_col, text, window, bucket_chars, block_chars).groupBy(F.col("id").alias("_id"), F.col("digest").alias("_digest")).agg(
        F.collect_set(F.struct("first", "after")).alias("_ranges"))
    rows = documents.select(F.struct(*[c for c in documents.columns if c != text]).alias("row"), F.col(text).alias("_text"), F.col(id_col).cast("long").alias("_id"), F.hash(text).alias("_digest"))
    joined = rows.join(cuts, ["_id", "_digest"], "left").select("row", "_text", "_ranges")
    out = StructType([joined.schema["row"], *[StructField(k, LongType()) for k in ("n_words", "n_removed")], StructField("kept_text", StringType())])
    return joined.mapInArrow(_kept, out)
