"""Word and document vectors: Word2Vec, mean vectors, neighbours, scaling, signatures."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigloom.functions.vectors import as_doubles, literal_array, sum_vectors
from sigloom.operators.kernel import assign, matrix_of, shared_codebook
from sigloom.scale import bounded_rows, settle

# Words whose neighbours are searched in one pass, about.
QUERY_BLOCK = 50_000
# Numbers in a block of the vector product, about: 80 MB.  The fewer blocks, the fewer partial sums of a document.
BLOCK_NUMBERS = 10_000_000
# Similarities computed at once, and found rows that are merged with the best so far.
_PRODUCT = 1_000_000
_MERGED = 2_000_000


def fit_word2vec(
    df: DataFrame, size: int = 100, min_count: int = 0, seed: int = 11, partitions: int = 8,
    tokens: str = "tokens",
) -> Word2VecModel:
    """Word2Vec with window 5, step 0.025 and one pass.

    ``partitions`` train in parallel and are averaged, so their number is part
    of the model and does not follow the cluster; raise it, and ``min_count``,
    on a large corpus, since Spark holds the vocabulary on the driver.
    """
    trainer = Word2Vec(
        vectorSize=size, minCount=min_count, seed=seed, numPartitions=partitions,
        inputCol=tokens, outputCol="vector", windowSize=5, stepSize=0.025, maxIter=1,
    )
    return trainer.fit(df)


def word_vectors(model: Word2VecModel) -> DataFrame:
    """Table (word, vector) of a fitted model."""
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))


def vector_size(df: DataFrame, vector: str = "vector") -> int:
    """Length of the vectors, read from one row."""
    row = df.select(F.size(vector)).first()
    if row is None:
        raise ValueError("no vectors")
    return row[0]


def embed(postings: DataFrame, vectors: DataFrame, keys: Sequence[str] = ("doc_id",), size: int | None = None) -> DataFrame:
    """Mean word vector of each document from (keys…, term, tf) rows, as a product of sparse rows with blocks of vectors.

    The mean is over all tokens: unknown words count as zero vectors.  A row
    with null term (document without tokens) gives a zero vector.
    """
    return _product(postings, vectors, keys, size, True)


def vector_sums(postings: DataFrame, vectors: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """(keys…, vector): the sum of tf times the vector of the term over the (keys…, term, tf) rows of each document.

    Unknown words and null terms count as zero vectors.
    """
    return _product(postings, vectors, keys, size, False)


def _product(postings: DataFrame, vectors: DataFrame, keys: Sequence[str], size: int | None, mean: bool) -> DataFrame:
    """Sums or means of word vectors for ``vector_sums`` and ``embed``.

    Vectors are packed into blocks by a hash of the word, documents are dealt into lanes by a hash of their keys.  A task
    holds one block of vectors and reads the postings of one lane that need it, sorted by document, so a posting carries
    a hash and a count and never a vector, and a document gives one partial sum for each block.
    """
    size = vector_size(vectors) if size is None else size
    keys = list(keys)
    context = postings.sparkSession.sparkContext
    known = vectors.select(F.xxhash64("word").alias("word"), as_doubles("vector").alias("vector"))
    blocks = max(1, -(-vectors.count() * size // BLOCK_NUMBERS))
    # At least as many tasks as the rows come in, so that a task's rows do not grow with the input.
    lanes = max(1, -(-max(context.defaultParallelism, postings.rdd.getNumPartitions()) // blocks))

    def block_of(column: str) -> Column:
        return F.pmod(F.col(column), F.lit(blocks)).cast("int")

    packed = known.withColumn("block", block_of("word")).groupBy("block").applyInPandas(_pack, "block int, words binary, matrix binary")
    null = F.lit(None)
    sides = packed.select(F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"), "block", F.lit(0).alias("kind"), "words", "matrix")
    for c in keys:
        sides = sides.withColumn(c, null.cast(postings.schema[c].dataType))
    sides = sides.withColumn("term", null.cast("long")).withColumn("tf", null.cast("double"))
    # A row without a term belongs to any block.
    hashed = F.when(F.col("term").isNotNull(), F.xxhash64("term")).alias("term")
    rows = postings.select(*keys, hashed, F.coalesce(F.col("tf"), F.lit(0)).cast("double").alias("tf"))
    rows = rows.select(
        F.pmod(F.xxhash64(*keys), F.lit(lanes)).cast("int").alias("lane"), F.coalesce(block_of("term"), F.lit(0)).alias("block"),
        F.lit(1).alias("kind"), null.cast("binary").alias("words"), null.cast("binary").alias("matrix"), *keys, "term", "tf",
    )
    order = ["lane", "block", "kind", *keys]
    dealt = sides.select(rows.columns).unionByName(rows).repartition(lanes * blocks, "lane", "block").sortWithinPartitions(*order)
    out = T.StructType([postings.schema[c] for c in keys]).add("s", T.ArrayType(T.DoubleType())).add("n", T.DoubleType())
    partial = dealt.mapInArrow(_partial_sums(keys, size), out)
    together = partial.repartition(*keys).sortWithinPartitions(*keys)
    final = T.StructType([postings.schema[c] for c in keys]).add("vector", T.ArrayType(T.DoubleType()))
    return together.mapInArrow(_totals(keys, size, mean), final)


def _pack(frame):
    """A block of vectors as one row, by word."""
    import pandas as pd

    frame = frame.sort_values("word")
    matrix = np.stack(frame["vector"].to_numpy()).astype(np.float64)
    words = frame["word"].to_numpy(np.int64)
    return pd.DataFrame({"block": [int(frame["block"].iloc[0])], "words": [words.tobytes()], "matrix": [matrix.tobytes()]})


def _starts(batch, keys: list[str]) -> np.ndarray:
    """Where the keys of sorted rows change; nulls are equal to each other."""
    new = np.zeros(batch.num_rows, dtype=bool)
    new[:1] = True
    for c in keys:
        codes = batch.column(c).dictionary_encode()
        codes = codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes
        place = codes.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= place[1:] != place[:-1]
    return np.flatnonzero(new)


def _lists(matrix: np.ndarray) -> pa.Array:
    offsets = pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1])
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel()))


def _partial_sums(keys: list[str], size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, words, matrix = None, np.empty(0, np.int64), np.zeros((0, size))
        for batch in batches:
            for a, b in _segments(batch, ["lane", "block", "kind"]):
                part = batch.slice(a, b - a)
                lane, block, kind = (part.column(c)[0].as_py() for c in ("lane", "block", "kind"))
                if (lane, block) != task:
                    task, words, matrix = (lane, block), np.empty(0, np.int64), np.zeros((0, size))
                if kind == 0:
                    words = np.frombuffer(part.column("words")[0].as_buffer(), dtype=np.int64)
                    matrix = np.frombuffer(part.column("matrix")[0].as_buffer()).reshape(len(words), -1)
                    if matrix.shape[1] != size:
                        raise ValueError(f"vectors must have {size} numbers")
                    continue
                term = part.column("term").fill_null(0).to_numpy(zero_copy_only=False)
                tf = part.column("tf").to_numpy(zero_copy_only=False)
                place = np.searchsorted(words, term)
                found = (place < len(words)) & part.column("term").is_valid().to_numpy(zero_copy_only=False)
                found[found] = words[place[found]] == term[found]
                rows = np.zeros((len(term), size))
                rows[found] = matrix[place[found]] * tf[found, None]
                starts = _starts(part, keys)
                sums, counts = np.add.reduceat(rows, starts, axis=0), np.add.reduceat(tf, starts)
                first = part.select(keys).take(pa.array(starts))
                yield pa.record_batch([*first.columns, _lists(sums), pa.array(counts)], names=[*keys, "s", "n"])

    return run


def _segments(batch: pa.RecordBatch, columns: list[str]) -> Iterator[tuple[int, int]]:
    starts = _starts(batch, columns)
    yield from zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows], strict=True)


def _totals(keys: list[str], size: int, mean: bool):
    """Adds up the partial sums of each document, which arrive side by side, and for means divides by its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            starts = _starts(table, keys)
            if len(starts):
                cut = int(starts[-1])
                if cut:
                    yield added(table.slice(0, cut).combine_chunks())
                rest = table.slice(cut)
        if rest is not None and rest.num_rows:
            yield added(rest.combine_chunks())

    def added(table: pa.Table) -> pa.RecordBatch:
        starts = _starts(table, keys)
        sums = table["s"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
        total = np.add.reduceat(sums, starts, axis=0)
        if mean:
            total /= np.maximum(np.add.reduceat(table["n"].to_numpy(), starts), 1)[:, None]
        first = table.select(keys).take(pa.array(starts)).combine_chunks()
        return pa.record_batch([*(c.combine_chunks() for c in first.columns), _lists(total)], names=[*keys, "vector"])

    return run


def synonyms(
    queries: DataFrame, vectors: DataFrame, k: int = 10, word: str = "word", vector: str = "vector"
) -> DataFrame:
    """The ``k`` nearest words by cosine for each query word: (query, rank, word, similarity).

    The queries go to every task as one matrix, in blocks of bounded size; a
    task keeps only its k best rows per query, so tasks * queries * k
    rows are shuffled instead of all pairs.  A word is not its own neighbour;
    of equal similarities (to six digits) the smaller word comes first.
    """
    asked = settle(queries.select(word, as_doubles(vector).alias("v")), "asked")
    kind = vectors.schema[word].dataType
    out = T.StructType().add("query", kind).add(word, kind).add("similarity", T.DoubleType())
    source = vectors.select(word, as_doubles(vector).alias("_v"))
    count = asked.count()
    if not count:
        return vectors.sparkSession.createDataFrame([], out.add("rank", T.IntegerType()))
    blocks = -(-count // QUERY_BLOCK)
    found = []
    for number in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64(word), F.lit(blocks)) == number)
        # A block is bounded by the spread of the hash.
        rows = bounded_rows(own, 2 * QUERY_BLOCK + 1000, "synonym queries of a block")
        if rows:
            found.append(source.mapInArrow(_neighbours(vectors.sparkSession, rows, k, word, kind), out))
    window = Window.partitionBy("query").orderBy(F.desc("similarity"), F.asc(word))
    partial = reduce(DataFrame.unionByName, found)
    return partial.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def _neighbours(spark, rows: list, k: int, word: str, kind: T.DataType):
    rows = sorted(rows, key=lambda r: r[0])
    matrix = np.array([r[1] for r in rows])
    lengths = np.sqrt((matrix**2).sum(axis=1))
    shared = shared_codebook(spark, matrix / np.where(lengths > 0, lengths, 1.0)[:, None])
    names = [r[0] for r in rows]
    arrow_kind = pa.string() if isinstance(kind, T.StringType) else pa.int64() if isinstance(kind, T.LongType) else pa.int32()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        codes: dict = {}
        own = np.array([codes.setdefault(name, len(codes)) for name in names])
        # Words are known by the order in which they come; the best rows so far, and those found since, not yet merged.
        words: list = []
        held = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        fresh, size = [], 0
        floor = np.full(len(names), -np.inf)
        step = max(64, _PRODUCT // len(names))

        def merge() -> None:
            """The k first of each query, and its k-th similarity as the floor of what comes."""
            nonlocal held, fresh, size
            query, word_id, score = (np.concatenate(x) for x in zip(held, *fresh, strict=True))
            met, place = np.unique(word_id, return_inverse=True)
            _, rank = np.unique(np.array([words[i] for i in met], dtype=object), return_inverse=True)
            order = np.lexsort((rank[place], -score, query))
            query, word_id, score = query[order], word_id[order], score[order]
            kept = np.arange(len(query)) - np.searchsorted(query, query) < k
            held, fresh, size = (query[kept], word_id[kept], score[kept]), [], 0
            full = np.flatnonzero(np.bincount(held[0], minlength=len(names)) == k)
            floor[full] = held[2][np.searchsorted(held[0], full, side="right") - 1]

        for batch in batches:
            known = batch.column(0).to_pylist()
            points = matrix_of(batch.column(1), table.shape[1])
            norm = np.sqrt((points**2).sum(axis=1))
            points = points / np.where(norm > 0, norm, 1.0)[:, None]
            for start in range(0, len(points), step):
                block = known[start : start + step]
                cosine = points[start : start + step] @ table.T
                least = floor
                open_ends = np.flatnonzero(np.isneginf(floor))
                if len(open_ends) and len(block) > k + 1:
                    # Queries without a floor take one row more than k, since a word may meet itself.
                    least = floor.copy()
                    least[open_ends] = np.round(np.partition(cosine[:, open_ends], len(block) - k - 1, axis=0)[len(block) - k - 1], 6)
                # Rounding moves a similarity by half a millionth at most, so only rows that near are rounded.
                place, query = np.nonzero(cosine >= least - 6e-7)
                score = np.round(cosine[place, query], 6) + 0.0
                kept = score >= least[query]
                place, query, score = place[kept], query[kept], score[kept]
                other = np.array([codes.get(w, -1) for w in block])[place] != own[query]
                fresh.append((query[other], place[other] + len(words), score[other]))
                size += int(other.sum())
                words += block
                if size > _MERGED:
                    merge()
        if fresh:
            merge()
        columns = [pa.array([names[i] for i in held[0]], arrow_kind), pa.array([words[i] for i in held[1]], arrow_kind), pa.array(held[2], pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, ["query", word, "similarity"])

    return run


def fit_min_max(df: DataFrame, vector: str = "vector") -> tuple[list[float], list[float]]:
    """Smallest and largest value of each dimension."""
    size = vector_size(df, vector)
    values = as_doubles(vector)
    bounds = df.agg(
        F.array(*[F.min(values[i]) for i in range(size)]).alias("low"),
        F.array(*[F.max(values[i]) for i in range(size)]).alias("high"),
    ).first()
    return bounds["low"], bounds["high"]


def min_max_scale(df: DataFrame, low: Sequence[float], high: Sequence[float], vector: str = "vector") -> DataFrame:
    """Scale each dimension to [0, 1], clipping values outside the fitted range; a constant dimension becomes 0.5."""
    span = literal_array([h - l for h, l in zip(high, low)])
    moved = F.zip_with(as_doubles(vector), literal_array(low), lambda v, l: v - l)

    def one(v: Column, s: Column) -> Column:
        return F.when(s == 0, F.lit(0.5)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), v / s)))

    return df.withColumn(vector, F.zip_with(moved, span, one))


def mean_vectors(df: DataFrame, by: str, vector: str = "vector", size: int | None = None) -> DataFrame:
    """Mean vector per group (by, n, vector): the signature of each class."""
    size = vector_size(df, vector) if size is None else size
    values = as_doubles(vector)
    added = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), sum_vectors(values, size).alias("_s"))
    return added.select(by, "n", F.transform("_s", lambda v: v / F.col("n")).alias("vector"))


def nearest_signature(
    df: DataFrame, signatures: Sequence[tuple], keys: Sequence[str], norm: str = "l2", vector: str = "vector"
) -> DataFrame:
    """(keys…, signature, distance) for a model-sized list of (name, vector) signatures; l2 is not squared."""
    names = [s[0] for s in signatures]
    found = assign(df, keys, vector, np.array([s[1] for s in signatures]), norm)
    distance = F.sqrt("dist") if norm == "l2" else F.col("dist")
    lookup = F.array(*[F.lit(n) for n in names])
    return found.select(*keys, F.get(lookup, F.col("unit")).alias("signature"), distance.alias("distance"))
