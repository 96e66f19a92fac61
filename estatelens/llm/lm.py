"""Language-model scoring by a causal self-attention model trained in numpy on subword ids.

Words are told apart and numbered by Arrow in blocks of ``BLOCK_CHARS`` characters, so that Python handles each distinct word
of a block once. They are counted over all training documents: once per Arrow batch inside tasks, then by a partially aggregated
group-by. The base score looks a word's count up in a broadcast table of at most ``HOT_WORDS`` most frequent words; all
other words go through a join.

The model works on subword ids of lower-cased words (a public vocabulary, given by path). Ids are counted over the whole
training corpus through the word counts. The most frequent ids are leaves of their own, the others are binned by
frequency into ``BINS`` leaves. Leaves form ``CLASSES`` classes of ``MEMBERS``, and
P(id | context) = P(class | context) * P(leaf | class, context) * P(id | leaf): the first two factors come from one
causal self-attention block by a softmax over the classes and one over the members of the class at hand, which costs
``CLASSES`` + ``MEMBERS`` terms an id and not their product; the third comes from smoothed counts. Training runs on all
training documents, each in one of ``ROUNDS`` rounds and there in one group of about ``GROUP_DOCS``, dealt by hash; in a
round a task trains a copy of the model on each group, and copies are averaged by their tokens. Work and what is gathered
grow with the corpus; what the driver sees is the size of the model and the vocabulary.

Scoring cuts a text into windows of ``WINDOW`` ids that overlap by ``WINDOW`` - ``STRIDE``; a window scores the ids that
the one before did not reach, under masked attention in batches, so that each id counts once.

Edge cases: null and empty texts are one end token; a null id counts as an empty one for the held-out rule; repeated
rows are scored and counted each; without training documents the base score uses zero counts and the model its initial
weights; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, staged
from .tokens import process_store

ship(__name__)

HOT_WORDS = 200_000
GROUP_DOCS = 256
ROUNDS = 2
EPOCHS = 1
RATE = 0.04
STEPS, BATCH = 128, 160  # a group trains by about as many steps at least, on as many windows a step at most
CLASSES, MEMBERS = 32, 32
LEAVES, BINS = CLASSES * MEMBERS, 16
WIDTH, HIDDEN = 16, 32
WINDOW, STRIDE = 20, 16
CHUNK = 512  # windows that are scored at once
VOCABULARY = 50_257
END = VOCABULARY  # one id past the vocabulary
END_BYTES = np.array([END], "<u2").tobytes()
CACHE_WORDS = 300_000
BLOCK_CHARS = 1 << 20  # text that is scored at once


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def spelled(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(number of each token's word, the words by number, tokens of each text); the empty word ends a text. Arrow tells words
    apart, so that Python sees each distinct one once."""
    mark = lambda x: pa.scalar(x, pa.large_string())
    texts = texts.take(pa.array(np.arange(len(texts)))).cast(pa.large_string())  # Arrow's text functions err on a slice that was cast
    low = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    low = pc.if_else(pc.equal(low, mark("")), low, pc.binary_join_element_wise(low, mark(""), mark(" ")))
    lists = pc.ascii_split_whitespace(low)
    parts = lists.flatten().dictionary_encode()
    return parts.indices.to_numpy(zero_copy_only=False), parts.dictionary.cast(pa.large_binary()).to_pylist(), np.diff(lists.offsets.to_numpy())


class Subwords:
    """Ids of words, with a cache that lives as long as the process."""

    def __init__(self, path: str):
        kept = process_store(f"subwords {path}")
        if not kept:
            import base64

            import public_tokenizers
            import tiktoken

            with open(path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            kept["coder"], kept["ids"] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), {}
        self.coder, self.cache = kept["coder"], kept["ids"]

    def of(self, many: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 16-bit ids of each word."""
        got = list(map(self.cache.get, many))
        for i, g in enumerate(got):
            if g is None:
                w = many[i]
                got[i] = g = np.array(self.coder.encode_ordinary(" " + w.decode("utf-8", "replace")), "<u2").tobytes()
                if len(self.cache) < CACHE_WORDS and len(w) <= 24:
                    self.cache[w] = g
        return got


def spelled_ids(words: list[bytes], number: np.ndarray, ids: Subwords) -> tuple[np.ndarray, np.ndarray]:
    """(the ids of all tokens, one after another, where each token's ids end)."""
    known = pa.array([p if w else END_BYTES for w, p in zip(words, ids.of(words))], pa.large_binary())
    got = known.take(pa.array(number))
    _, ends, data = got.buffers()
    ends = np.frombuffer(ends, np.int64)[1:len(got) + 1] // 2
    return np.frombuffer(data, "<u2", ends[-1]), ends


def blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``BLOCK_CHARS`` characters, one text at least."""
    begin = held = 0
    for i, size in enumerate(pc.fill_null(pc.utf8_length(texts), 0).to_pylist()):
        if i > begin and held + size + 64 > BLOCK_CHARS:
            yield begin, i
            begin, held = i, 0
        held += size + 64
    if len(texts):
        yield begin, len(texts)


def new_model(frequency: np.ndarray) -> dict[str, np.ndarray]:
    """Initial weights; the biases give each leaf its frequency."""
    r = np.random.default_rng(5)
    n = lambda *shape: r.normal(0, 0.3 / np.sqrt(WIDTH), shape)
    share = frequency.reshape(CLASSES, MEMBERS)
    top = share.sum(axis=1)
    return {"emb": r.normal(0, 0.3, (LEAVES + 1, WIDTH)), "pos": r.normal(0, 0.1, (WINDOW, WIDTH)), "q": n(WIDTH, WIDTH), "k": n(WIDTH, WIDTH), "v": n(WIDTH, WIDTH), "o": n(WIDTH, WIDTH),
            "w1": n(WIDTH, HIDDEN), "b1": np.zeros(HIDDEN), "w2": n(HIDDEN, WIDTH), "out": n(WIDTH, CLASSES), "bias": np.log(top),
            "leaf": n(CLASSES, WIDTH, MEMBERS), "leaf_bias": np.log(share / top[:, None])}


MASK = np.tril(np.ones((WINDOW, WINDOW), np.float32))


def _dense(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """x @ w for windows x places x width, as one matrix product."""
    return (x.reshape(-1, x.shape[2]) @ w).reshape(*x.shape[:2], w.shape[1])


def _bounded_exp(x: np.ndarray) -> None:
    if x.max(initial=0) > 60:
        np.minimum(x, 60, out=x)
    np.exp(x, out=x)


def hidden(m: dict, inp: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Output vector at each place of each window, and what the backward pass needs."""
    x = m["emb"].take(inp, axis=0)
    x += m["pos"]
    q, k, v = _dense(x, m["q"] * np.float32(1 / np.sqrt(WIDTH))), _dense(x, m["k"]), _dense(x, m["v"])
    a = q @ k.transpose(0, 2, 1)
    _bounded_exp(a)
    a *= MASK
    a /= a @ np.ones((WINDOW, 1), a.dtype)  # a sum over the last axis as a matrix product, which is faster
    c = a @ v
    y = _dense(c, m["o"])
    y += x
    h = _dense(y, m["w1"])
    h += m["b1"]
    np.maximum(h, 0, out=h)
    z = _dense(h, m["w2"])
    z += y
    return z, (x, q, k, v, a, c, y, h)


def _chosen(logits: np.ndarray, pick: np.ndarray, parts: list[slice], slopes: bool) -> np.ndarray:
    """Log probability of ``pick`` under the softmax of each row, summed part by part; with ``slopes`` its slope by each logit
    takes the place of the logits."""
    at = np.arange(len(pick)) * logits.shape[1] + pick
    got = np.minimum(logits.ravel()[at], 60)
    _bounded_exp(logits)
    ones, total = np.ones((logits.shape[1], 1), logits.dtype), np.empty((len(logits), 1), logits.dtype)
    for p in parts:
        np.matmul(logits[p], ones, out=total[p])
    got -= np.log(total[:, 0])
    if slopes:
        np.negative(total, out=total)
        logits /= total
        logits.reshape(-1)[at] += 1
    return got


def log_likelihood(m: dict, z: np.ndarray, targets: np.ndarray, slopes: bool = False) -> tuple[np.ndarray, np.ndarray | None, dict]:
    """Log probability of each target leaf at its output vector; with ``slopes`` also the gradients of their sum by ``z``
    and by the weights of both softmax levels. Rows lie sorted by class, so that only matrix products go class by class."""
    of, member = targets // MEMBERS, targets % MEMBERS
    d = z @ m["out"]
    d += m["bias"]
    got = _chosen(d, of, [slice(None)], slopes)
    order, ends = np.argsort(of, kind="stable"), np.append(0, np.cumsum(np.bincount(of, minlength=CLASSES))).tolist()
    parts = [(c, slice(a, b)) for c, (a, b) in enumerate(zip(ends, ends[1:])) if a < b]
    own, e = z.take(order, axis=0), np.empty((len(z), MEMBERS), z.dtype)
    for c, at in parts:
        np.matmul(own[at], m["leaf"][c], out=e[at])
    e += m["leaf_bias"].take(of[order], axis=0)
    got[order] += _chosen(e, member[order], [at for _, at in parts], slopes)
    if not slopes:
        return got, None, {}
    g = {"out": z.T @ d, "bias": d.sum(0), "leaf": np.zeros_like(m["leaf"]), "leaf_bias": np.zeros_like(m["leaf_bias"])}
    more = np.empty_like(z)
    for c, at in parts:
        np.matmul(e[at], m["leaf"][c].T, out=more[at])
        np.matmul(own[at].T, e[at], out=g["leaf"][c])
        np.add.reduce(e[at], 0, out=g["leaf_bias"][c])
    dz = d @ m["out"].T
    dz[order] += more
    return got, dz, g


def backward(m: dict, inp: np.ndarray, state: tuple, dz: np.ndarray) -> dict[str, np.ndarray]:
    x, q, k, v, a, c, y, h = state
    scale = np.float32(1 / np.sqrt(WIDTH))
    dot = lambda p, r: p.reshape(-1, p.shape[2]).T @ r.reshape(-1, r.shape[2])
    g = {"w2": dot(h, dz)}
    dh = _dense(dz, m["w2"].T)
    dh *= h > 0
    g["w1"], g["b1"] = dot(y, dh), dh.sum((0, 1))
    dx = _dense(dh, m["w1"].T)
    dx += dz
    g["o"] = dot(c, dx)
    dc = _dense(dx, m["o"].T)
    ds, dv = dc @ v.transpose(0, 2, 1), a.transpose(0, 2, 1) @ dc
    ds -= (ds * a).sum(2, keepdims=True)
    ds *= a
    dq, dk = ds @ k, ds.transpose(0, 2, 1) @ q  # q is scaled already
    dq *= scale
    for n, d in (("q", dq), ("k", dk), ("v", dv)):
        g[n] = dot(x, d)
        dx += _dense(d, m[n].T)
    g["pos"] = dx.sum(0)
    leaf = inp.ravel()
    order = np.argsort(leaf, kind="stable")
    leaf = leaf[order]
    heads = np.flatnonzero(np.append(True, leaf[1:] != leaf[:-1]))
    g["emb"] = np.zeros_like(m["emb"])
    g["emb"][leaf[heads]] = np.add.reduceat(dx.reshape(-1, WIDTH).take(order, axis=0), heads, axis=0)
    return g


def windows(leaves: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, targets, scored places, document) of the windows over the leaf sequences; LEAVES is the start mark."""
    sizes = np.array([len(c) for c in leaves])
    flat = np.concatenate(leaves)
    heads = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    each = 1 + -(-np.maximum(sizes - WINDOW, 0) // STRIDE)
    doc = np.repeat(np.arange(len(sizes)), each)
    begin = (np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each)) * STRIDE
    place = (begin[:, None] + np.arange(WINDOW)).astype(np.int32)
    valid = place < sizes[doc][:, None].astype(np.int32)
    at = np.minimum(heads[doc][:, None].astype(np.int32) + place, np.int32(len(flat) - 1))
    targets = flat[at]
    inputs = np.where(place > 0, flat[np.maximum(at - 1, 0)], LEAVES)
    return inputs, targets, valid & ((begin[:, None] == 0) | (np.arange(WINDOW) >= WINDOW - STRIDE)), doc


def train(m: dict, leaves: list[np.ndarray], epochs: int, seed: int) -> dict:
    """The model after ``epochs`` of Adam over the sequences."""
    inputs, targets, scored, _ = windows(leaves)
    flat = _flat(m)
    m = _shaped(flat, m)  # parts of ``flat``
    first, second, more = np.zeros_like(flat), np.zeros_like(flat), np.empty_like(flat)
    r, step = np.random.default_rng(seed), 0
    batch = int(np.clip(len(inputs) // STEPS, 16, BATCH))
    total = epochs * -(-len(inputs) // batch)
    for _ in range(epochs):
        order = r.permutation(len(inputs))
        for b in range(0, len(order), batch):
            pick = order[b:b + batch]
            inp, at = inputs[pick], np.flatnonzero(scored[pick])
            z, state = hidden(m, inp)
            dz = np.zeros_like(z)
            _, dz.reshape(-1, WIDTH)[at], grads = log_likelihood(m, z.reshape(-1, WIDTH).take(at, axis=0), targets[pick].ravel()[at], True)
            grads |= backward(m, inp, state, dz)
            g = _flat(grads)
            g *= np.float32(-1 / max(1, len(at)))
            step += 1
            np.subtract(g, first, out=more)
            more *= np.float32(0.1)
            first += more
            g *= g
            g -= second
            g *= np.float32(0.01)
            second += g
            np.divide(second, np.float32(1 - 0.99 ** step), out=g)
            np.sqrt(g, out=g)
            g += np.float32(1e-8)
            np.divide(first, np.float32(1 - 0.9 ** step), out=more)
            more *= np.float32(RATE * (1 - 0.9 * step / total))
            more /= g
            flat -= more
    return m


def score(m: dict, leaves: list[np.ndarray]) -> np.ndarray:
    """Log10 probability of each leaf sequence."""
    inputs, targets, scored, doc = windows(leaves)
    out = np.zeros(len(leaves))
    for b in range(0, len(doc), CHUNK):
        at = np.flatnonzero(scored[b:b + CHUNK])
        got = log_likelihood(m, hidden(m, inputs[b:b + CHUNK])[0].reshape(-1, WIDTH).take(at, axis=0), targets[b:b + CHUNK].ravel()[at])[0]
        out += np.bincount(doc[b + at // WINDOW], weights=got, minlength=len(leaves))
    return out / np.log(10)


def _flat(m: dict) -> np.ndarray:
    return np.concatenate([m[k].ravel() for k in sorted(m)]).astype(np.float32, copy=False)


def _shaped(values: np.ndarray, like: dict) -> dict:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = np.asarray(values[at:at + like[k].size], np.float32).reshape(like[k].shape)
        at += like[k].size
    return out


def _counted(train_docs: DataFrame) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[bytes, int] = {}
            for first, last in blocks(b.column(0)):
                number, many, _ = spelled(b.column(0).slice(first, last - first))
                for w, n in zip(many, np.bincount(number, minlength=len(many)).tolist()):
                    seen[w] = seen.get(w, 0) + n
            yield pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    return staged(train_docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c")), "lm-words")


def _subword_counts(counts: DataFrame, path: str) -> np.ndarray:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, total = Subwords(path), np.zeros(VOCABULARY + 1, np.int64)
        for b in batches:
            many, n = b.column(0).to_pylist(), np.array(b.column(1).to_pylist(), np.int64)
            parts = ids.of(many)
            total += np.bincount(np.frombuffer(b"".join(parts), "<u2"), weights=np.repeat(n, [len(p) // 2 for p in parts]), minlength=VOCABULARY + 1).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["id", "n"])

    out = np.zeros(VOCABULARY + 1)
    for r in counts.where(F.length("word") > 0).mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():  # one row per id of the vocabulary
        out[r["id"]] = r["n"]
    out[END] = sum(r["c"] for r in counts.where(F.length("word") == 0).collect())
    return out


def leaf_table(n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(leaf of each id, log10 probability of the id within it, share of the leaves) from id counts."""
    smooth = n + 0.5
    order = np.argsort(-smooth, kind="stable")
    order = np.concatenate([[END], order[order != END]])
    of, singles = np.zeros(len(n), np.int64), LEAVES - BINS
    of[order[:singles]] = np.arange(singles)
    rest = order[singles:]
    mass = np.cumsum(smooth[rest])
    of[rest] = singles + np.minimum((mass - smooth[rest]) / mass[-1] * BINS, BINS - 1).astype(np.int64)
    total = np.maximum(np.bincount(of, weights=smooth, minlength=LEAVES), 1e-9)
    return of, np.log10(smooth / total[of]), total / total.sum()


def dealt_out(learn: DataFrame, n: int) -> DataFrame:
    """All ``n`` training documents with hash ``h``, round ``turn`` and group ``g`` within the round."""
    h = F.xxhash64("id", "text", F.lit(23))
    groups = max(1, round(n / ROUNDS / GROUP_DOCS))
    return learn.select("text", h.alias("h"), F.pmod(h, F.lit(ROUNDS)).alias("turn"), F.pmod(F.shiftright(h, 8), F.lit(groups)).alias("g"))


def scored(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    path = path or vocabulary()
    held = F.pmod(F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1
    own = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    learn = own.where(~held)
    counts = _counted(learn)
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    floor = 0.5 * (distinct + 1) + total
    hot = counts.orderBy(F.desc("c"), "word").limit(HOT_WORDS).toArrow()
    hot_words, hot_logs = hot.column("word").to_pylist(), np.append(np.log10((np.array(hot.column("c").to_pylist(), float) + 0.5) / floor), 0.0)
    of, within, frequency = leaf_table(_subword_counts(counts, path))
    of, model = of.astype(np.uint16), new_model(frequency)

    dealt = dealt_out(learn, sum(r["c"] for r in counts.where(F.length("word") == 0).collect()))

    def learner(before: dict, turn: int):
        def learnt(part: pa.Table) -> pa.Table:
            texts, ids, seq = part.sort_by("h").column("text").combine_chunks(), Subwords(path), []
            for first, last in blocks(texts):
                number, many, n = spelled(texts.slice(first, last - first))
                code, ends = spelled_ids(many, number, ids)
                seq += np.split(of[code], ends[np.cumsum(n)[:-1] - 1])
            w = _flat(train(before, seq, EPOCHS, turn))
            return pa.table({"w": pa.array([w], pa.list_(pa.float32())), "n": [float(sum(map(len, seq)))]})

        return learnt

    for turn in range(ROUNDS):
        copies = dealt.where(F.col("turn") == turn).groupBy("g").applyInArrow(learner(model, turn), "w array<float>, n double")
        mean = copies.select(F.posexplode("w").alias("i", "x"), "n").groupBy("i").agg((F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("x")).orderBy("i").collect()  # one row per weight
        if mean:
            model = _shaped(np.array([r["x"] for r in mean]), model)
    model = {k: v.astype(np.float32) for k, v in model.items()}

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, missing, ids = {w: i for i, w in enumerate(hot_words)}, len(hot_words), Subwords(path)
        for b in batches:
            for first, last in blocks(b.column(1)):
                number, many, n = spelled(b.column(1).slice(first, last - first))
                heads = np.cumsum(n) - n
                rows = np.array([place.get(w, missing) for w in many])[number]
                rare = np.flatnonzero(rows == missing)
                cuts = np.searchsorted(rare, np.append(heads, len(rows)))
                tails = [Counter([many[i] for i in number[rare[u:v]]]) for u, v in zip(cuts, cuts[1:])]
                code, ends = spelled_ids(many, number, ids)
                begins = np.append(0, ends[heads[1:] - 1])
                lm = score(model, np.split(of[code], begins[1:])) + np.add.reduceat(within[code], begins)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, last - first), pa.array(n, pa.int64()), pa.array(n - np.diff(cuts), pa.int64()),
                                                  pa.array(np.add.reduceat(hot_logs[rows], heads), pa.float64()), pa.array(lm, pa.float64()),
                                                  pa.array([list(t.keys()) for t in tails], pa.list_(pa.binary())), pa.array([list(t.values()) for t in tails], pa.list_(pa.int64()))],
                                                 names=["id", "n_tokens", "known", "base", "score", "tail", "times"])

    kind = own.schema["id"].dataType.simpleString()
    rows = own.mapInArrow(judged, f"id {kind}, n_tokens long, known long, base double, score double, tail array<binary>, times array<long>")
    rows = staged(rows.withColumn("_row", F.monotonically_increasing_id()), "lm-scores")
    rare = rows.select("_row", F.explode(F.arrays_zip("tail", "times")).alias("t")).select("_row", F.col("t.tail").alias("word"), F.col("t.times").alias("n"))
    c = F.coalesce("c", F.lit(0))
    rare = rare.join(counts, "word", "left").groupBy("_row").agg(F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("more"), F.sum(F.col("n") * F.log10((c + 0.5) / F.lit(floor))).alias("log"))
    out = rows.drop("tail", "times").join(rare, "_row", "left")
    return out.select(F.col("id").alias(id_col), held.alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
                      (F.col("base") + F.coalesce("log", F.lit(0.0))).alias("base_score"), "score")
