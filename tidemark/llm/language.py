"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import TEXT_ROWS, arrow_rows, giving_back, own_columns

BINS = 1 << 16
GRAMS = (1, 2, 3)
#: Labelled rows the model is fitted on, at most on average; chosen by hash of doc_id, as many of each language as there are.
TRAIN_ROWS = 60_000
#: Characters that are scored at a time; bounds the memory of a task whatever the length of a text.
CHUNK = 400_000
#: Characters times languages that are scored at a time; they take 12 bytes each, in every worker of an executor.
CELLS = 1_000_000
#: Prediction for texts that are null or have no letter.
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_MULTIPLY = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def _chunks(texts: list[str], chunk: int | None = None) -> Iterator[tuple[np.ndarray, list[str], np.ndarray]]:
    """The lower-cased texts in chunks of bounded size: owners, pieces, and how many places of a piece count. A long
    text is cut; a piece then goes on into the next so far that no gram is lost, and none counts twice."""
    chunk = chunk or CHUNK
    owners, pieces, counted, size = [], [], [], 0
    for i, text in enumerate(texts):
        low = text.lower()
        for start in range(0, len(low), chunk):
            piece = low[start : start + chunk + max(GRAMS) - 1]
            if pieces and size + len(piece) > chunk:
                yield np.array(owners), pieces, np.array(counted)
                owners, pieces, counted, size = [], [], [], 0
            owners.append(i)
            pieces.append(piece)
            counted.append(min(chunk, len(low) - start))
            size += len(piece)
    if pieces:
        yield np.array(owners), pieces, np.array(counted)


def _grams(pieces: list[str], counted: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each gram length: the bins of all places, and from where to where each piece's own places are."""
    lengths = np.array([len(t) for t in pieces], np.int64)
    begins = np.cumsum(lengths) - lengths
    chars = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), np.uint32)
    state = np.zeros(len(chars), np.uint32)
    for n in range(1, max(GRAMS) + 1):
        state = (state[: max(len(chars) - n + 1, 0)] ^ chars[n - 1 :]) * _MULTIPLY[(n - 1) % 3]
        state ^= state >> np.uint32(15)
        if n in GRAMS:
            ends = begins + np.maximum(np.minimum(counted, lengths - n + 1), 0)
            yield ((state * np.uint32(0x27D4EB2F)) >> np.uint32(16)).astype(np.int32) % BINS, begins, ends


def _summed(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros((len(values) + 1, values.shape[1]))
    np.cumsum(values, axis=0, out=total[1:])
    begins = np.minimum(begins, ends)
    return np.where((ends > begins)[:, None], total[np.minimum(ends, len(values))] - total[np.minimum(begins, len(values))], 0.0)


def shares(rows: dict[str, int], most: int) -> dict[str, float]:
    """The part of each language's rows that is taken: all of the rare ones, and of the others the same number, so that
    about `most` are taken in all."""
    left, level = most, float("inf")
    for place, n in enumerate(sorted(rows.values())):
        level = left / (len(rows) - place)
        if n > level:
            break
        left, level = left - n, float("inf")
    return {lang: min(1.0, level / n) for lang, n in rows.items()}


def learn(df: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log priors and the (bins, languages) log-probability matrix, from rows with text and lang.

    Priors are counted over all labelled rows. Grams are counted over a sample that is even over the languages, so that a
    rare one is learned whole. Each task adds up dense counts for the languages it meets; only those sums are shuffled.
    """
    labelled = own_columns(df, "doc_id", "text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    known = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each language
    below = [(lang, int(share * (1 << 20))) for lang, share in shares(known, train_rows).items()]
    quotas = df.sparkSession.createDataFrame(below, "lang string, _below long")
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20))
    chosen = labelled.join(F.broadcast(quotas), "lang").where(drawn < F.col("_below")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            texts = batch.column(1).to_pylist()
            for lang in set(langs.tolist()):
                own = [texts[i] for i in np.flatnonzero(langs == lang)]
                here = sums.setdefault(lang, np.zeros(BINS, np.int64))
                for _, pieces, counted in _chunks(own):
                    for bins, begins, ends in _grams(pieces, counted):
                        inside = np.zeros(len(bins) + 1, np.int32)
                        some = ends > begins
                        inside[begins[some]] += 1
                        np.add.at(inside, ends[some], -1)
                        here += np.bincount(bins[np.cumsum(inside[:-1]) > 0], minlength=BINS)
        for lang, here in sums.items():
            at = np.flatnonzero(here)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(at) + 1)), pa.array(np.r_[at, -1], pa.int32()), pa.array(np.r_[here[at], 0], pa.int64())], ["lang", "bin", "n"])

    spark = df.sparkSession
    with arrow_rows(spark):
        table = chosen.mapInArrow(giving_back(count), "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(table["lang"].unique().tolist())
    counts, priors = np.zeros((BINS, len(langs))), np.array([known[lang] for lang in langs], float)
    place = table["lang"].map({v: i for i, v in enumerate(langs)}).to_numpy(dtype=np.int64)
    bins, n = table["bin"].to_numpy(), table["n"].to_numpy()
    counts[bins[bins >= 0], place[bins >= 0]] = n[bins >= 0]
    smoothed = counts + 0.5
    return langs, np.log(np.maximum(priors, 1) / max(priors.sum(), 1)), np.log(smoothed / smoothed.sum(axis=0)).astype(np.float32)


def predict(df: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], columns: list[str] | None = None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """`columns` of `df` (by default doc_id) and, under `names`, the language and its posterior, 0 for `und`."""
    keep = columns or ["doc_id"]
    langs = model[0]
    chunk = max(1, min(CHUNK, CELLS // max(len(langs), 1)))
    shared = df.sparkSession.sparkContext.broadcast(model[1:])
    source = own_columns(df, *keep) if "text" in keep else own_columns(df, *keep, "text")
    fields = [f for f in source.schema.fields if f.name in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", {names[0]} string, {names[1]} double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        priors, matrix = shared.value
        for batch in (whole.slice(at, TEXT_ROWS) for whole in batches for at in range(0, whole.num_rows, TEXT_ROWS)):
            texts = [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            total = np.tile(priors, (len(texts), 1))
            for owners, pieces, counted in _chunks(texts, chunk):
                for bins, begins, ends in _grams(pieces, counted):
                    np.add.at(total, owners, _summed(matrix[bins], begins, ends))
            if langs:
                best = total.argmax(axis=1)
                posterior = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                known = [bool(_LETTER.search(t)) for t in texts]
            else:
                best, posterior, known = None, np.zeros(len(texts)), [False] * len(texts)
            chosen = [langs[best[i]] if ok else UNKNOWN for i, ok in enumerate(known)]
            out = [batch.column(batch.schema.get_field_index(f.name)) for f in fields]
            yield pa.RecordBatch.from_arrays(
                [*out, pa.array(chosen, pa.string()), pa.array(np.where(known, posterior, 0.0), pa.float64())], [*[f.name for f in fields], *names])

    return source.mapInArrow(giving_back(score), schema)


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def identify(df: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """For each row of `df` (doc_id, text, lang; others ignored): doc_id, held_out, lang_pred, score.

    Learned from rows that are not held out (crc32 of doc_id as text, modulo 3, is 1) and have text and lang. A text
    that is null or has no letter, and every text when nothing could be learned, is `und` with score 0. Repeated rows
    count as often as they come; of equally likely languages the first by name wins. An empty table gives no rows.
    """
    model = learn(df.where(~held_out()), train_rows)
    return predict(df, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def with_known_language(df: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of `df` that are not `und`, with all their columns."""
    model = learn(df.where(~held_out()), train_rows)
    marked = predict(df, model, df.columns, ("_language", "_posterior"))
    return marked.where(F.col("_language") != UNKNOWN).select(*[F.col(f"`{c}`") for c in df.columns])
