"""Language identification by nearest centroid.

Texts become TF-IDF vectors of hashed letter n-grams (one to three bytes of
lower-cased text, everything but letters counting as space), of length 1. Each
language has several centroids, found by clustering a bounded sample of its
texts; a text goes to the language of the centroid with the highest cosine.
Every centroid knows how far its own texts lie; a text beyond that is marked as
rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thornwall.llm.common import Scratch, named, small_batches

UNKNOWN = "und"
BITS = 12
_SIZE = 1 << BITS
_PIECE = 1 << 20
_LETTERS = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def _hashed(grams: np.ndarray, n: int) -> np.ndarray:
    return (grams * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(32 - BITS)


def counts(text: str) -> np.ndarray:
    """How often each hashed n-gram occurs in the whole text."""
    data = b" " + text.lower().encode().translate(_LETTERS) + b" "
    total = np.zeros(_SIZE, np.int64)
    for at in range(0, len(data), _PIECE):
        # Each piece brings the two bytes before it along, whose own n-grams are counted already.
        begin = max(0, at - 2)
        codes = np.frombuffer(data, np.uint8, min(len(data), at + _PIECE) - begin, begin).astype(np.uint32)
        new = at - begin
        for n in (1, 2, 3):
            if len(codes) < n:
                continue
            grams = codes[: len(codes) - n + 1]
            for k in range(1, n):
                grams = grams * np.uint32(257) + codes[k : len(codes) - n + 1 + k]
            blank = grams == (32, 32 * 257 + 32, (32 * 257 + 32) * 257 + 32)[n - 1]
            first = max(0, new - n + 1)
            total += np.bincount(_hashed(grams[first:][~blank[first:]], n), minlength=_SIZE)
    return total


@dataclass(frozen=True)
class Model:
    languages: list[str]  # of each centroid
    idf: np.ndarray
    centroids: np.ndarray
    reach: np.ndarray  # cosines below are rejected

    def vectors(self, found: list[np.ndarray]) -> np.ndarray:
        x = np.log1p(np.array(found, np.float32)) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _cluster(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart starts; (centroids, lowest usual cosine of their own)."""
    mean = x.mean(axis=0)
    chosen = [int(np.argmax(x @ mean))]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(np.argmin((x @ x[chosen].T).max(axis=1))))
    centroids = x[chosen]
    for _ in range(rounds):
        nearest = np.argmax(x @ centroids.T, axis=1)
        sums = np.array([x[nearest == c].sum(axis=0) if (nearest == c).any() else centroids[c] for c in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    cosines = x @ centroids.T
    nearest = np.argmax(cosines, axis=1)
    reach = [np.quantile(cosines[nearest == c, c], 0.005) if (nearest == c).any() else 1.0 for c in range(len(centroids))]
    return centroids, np.array(reach)


def _limits(distinct: DataFrame, sizes: dict[str, int], each: int) -> DataFrame:
    """(l, upto): of each language, the digests up to it are the ``each`` smallest, or all.

    The digests of a share somewhat larger come to the driver; if it holds too few, of a share twice as large.
    """
    session, wide, last = distinct.sparkSession, 2 * each, (1 << 63) - 1
    found = {lang: last for lang, n in sizes.items() if n <= each}
    while open_ := sorted(sizes.keys() - found.keys()):
        wide *= 2
        upto = [(lang, min(last, (wide << 64) // sizes[lang] - (1 << 63))) for lang in open_]
        near = distinct.join(F.broadcast(session.createDataFrame(upto, "l string, upto long")), F.col("lang") == F.col("l")).filter("digest <= upto")
        smallest: dict[str, list[int]] = {lang: [] for lang in open_}
        for r in near.select("lang", "digest").collect():
            smallest[r["lang"]].append(r["digest"])
        found |= {lang: sorted(digests)[each - 1] for lang, digests in smallest.items() if len(digests) >= each}
    return session.createDataFrame(sorted(found.items()), "l string, upto long")


def fit(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", centroids: int = 4, sample_rows: int = 2000, max_languages: int = 256) -> Model:
    """A model of rows with a language and a letter; others are left out.

    Document frequencies are counted over all rows. Clusters are fitted on
    distinct texts, each whole: of every language ``sample_rows`` / languages, 20
    at least, or all it has. Those with the smallest hashes are taken, so that
    neither copies nor repeated rows change a language's share, and about that
    many vectors come to the driver, at any size of the input. Of very many
    languages, as a column that is no language may hold, the ``max_languages``
    with most texts are learned, ties in order of name; so a model has at most
    that many times ``centroids`` rows of 16 KB. Ids play no part.
    """
    rows = rows.select(F.xxhash64(F.lit("sample"), named(text_col)).alias("digest"), named(lang_col).alias("lang"), named(text_col).alias("text"))
    rows = rows.filter("text is not null and lang is not null")
    scratch = Scratch(rows.sparkSession)

    small_batches(rows)

    def looked_at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per text with a letter, and the document frequencies of all of them."""
        names = ["digest", "lang", "gram", "docs"]
        found, n = np.zeros(_SIZE, np.int64), 0
        for batch in batches:
            at = []
            for i, text in enumerate(batch.column(2)):
                if has_letter(text.as_py()):
                    found += counts(text.as_py()) > 0
                    at.append(i)
            n += len(at)
            none = pa.nulls(len(at), pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(at, pa.int64())) for k in (0, 1)), none, none], names=names)
        none = [pa.nulls(_SIZE + 1, kind) for kind in (pa.int64(), pa.string())]
        yield pa.RecordBatch.from_arrays([*none, pa.array(np.arange(_SIZE + 1)), pa.array(np.append(found, n))], names=names)

    seen = scratch.keep(rows.mapInArrow(looked_at, "digest long, lang string, gram long, docs long"))
    summed = seen.filter("gram is not null").groupBy("gram").agg(F.sum("docs").alias("docs")).orderBy("gram").collect()
    docs = np.array([r["docs"] for r in summed] or [0] * (_SIZE + 1), np.float64)
    idf = (np.log((1 + docs[-1]) / (1 + docs[:-1])) + 1).astype(np.float32)

    distinct = scratch.keep(seen.filter("lang is not null").select("lang", "digest").distinct())
    largest = distinct.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages)
    sizes = {r["lang"]: r["count"] for r in largest.collect()}
    each = max(20, sample_rows // max(1, len(sizes)))
    limits = _limits(distinct, sizes, each)
    sample = rows.join(F.broadcast(limits), F.col("lang") == F.col("l")).filter("digest <= upto")

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()
        for batch in batches:
            at, found = [], []
            for i, (digest, lang, text) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)):
                if has_letter(text) and (digest, lang, hash(text)) not in done:
                    done.add((digest, lang, hash(text)))
                    at.append(i)
                    found.append(counts(text).astype(np.int32).tobytes())
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(found, pa.binary())], names=["digest", "lang", "counts"])

    texts = sample.select("digest", "lang", "text").mapInArrow(sampled, "digest long, lang string, counts binary").distinct().collect()
    texts.sort(key=lambda r: (r["lang"], r["digest"], r["counts"]))
    model = Model([], idf, np.zeros((0, _SIZE), np.float32), np.zeros(0))
    found, names, reach = [], [], []
    for lang in sorted({r["lang"] for r in texts}):
        x = model.vectors([np.frombuffer(r["counts"], np.int32) for r in texts if r["lang"] == lang])
        middle, far = _cluster(x, centroids)
        found.append(middle)
        reach.append(far)
        names += [lang] * len(middle)
    if not names:
        return model
    return Model(names, idf, np.concatenate(found).astype(np.float32), np.concatenate(reach))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang, score, rejected): a row per row of ``docs``.

    The score is the cosine to the nearest centroid, between 0 and 1. Texts that
    are null or have no letter, and all texts if the model has no language, get
    ``und`` and 0. ``rejected`` marks texts farther from the centroid than
    its own; of centroids equally near, the first language in order counts.
    """
    small_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.idf, model.centroids, model.reach))  # languages x centroids x 4096 floats
    rows = docs.select(named(id_col).alias("id"), named(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(1).to_pylist()
                langs, scores, far = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
                known = [i for i, t in enumerate(texts) if m.languages and has_letter(t)]
                if known:
                    cosines = m.vectors([counts(texts[i]) for i in known]) @ m.centroids.T
                    for i, c, s in zip(known, cosines.argmax(axis=1).tolist(), cosines.max(axis=1).tolist(), strict=True):
                        langs[i], scores[i], far[i] = m.languages[c], min(1.0, max(0.0, s)), bool(s < m.reach[c])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(far, pa.bool_())], names=["id", "lang", "score", "rejected"])

    return rows.mapInArrow(run, f"id {kind}, lang string, score double, rejected boolean")
