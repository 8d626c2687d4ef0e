"""Model importances and attributions."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from parcelcast.contracts import ContractError, MODEL_FEATURES, ORDER_KEY, TARGET
from parcelcast.operators.evaluation import ranking_metrics, ranking_of_counts
from parcelcast.operators.ordering import global_rank, with_scalar
from parcelcast.operators.preprocessing import feature_names
from parcelcast.operators.training import Model, SEED, score_rows
from parcelcast.operators.trees import TreeModel, hashed, path_contributions

FEISTEL_ROUNDS = 6


def native_importance(model: TreeModel) -> DataFrame:
    """The fitted trees' own importances by transformed feature name."""
    if not isinstance(model, TreeModel):
        raise ContractError("only trees have importances of their own")
    return SparkSession.active().createDataFrame(model.importances(), "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def permuted(positions: np.ndarray, n: int, *key: int) -> np.ndarray:
    """A keyed bijection on 0..n-1: Feistel rounds on the least even number of bits that hold n, repeated for the values that
    fall outside (they walk along their cycle until it comes back in). Each position is worked out by itself."""
    half = np.uint64(max(1, ((n - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = positions.astype(np.uint64), np.arange(len(positions))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for turn in range(FEISTEL_ROUNDS):
            left, right = right, left ^ (hashed(right, *key, turn) & mask)
        out[todo] = left << half | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def shuffled_pairs(df: DataFrame, repeats: int, seed: int, columns: Sequence[str]) -> DataFrame:
    """For each repeat, every row with the columns of another row, paired by a seeded random permutation.

    Ids are ranked once, on their own. A row then knows without any sorting to which position it lends its columns in each
    repeat, and one hash join on the position brings them there: wide rows are shuffled once a repeat, never ordered.
    """
    placed = df.join(global_rank(df.select(ORDER_KEY), [ORDER_KEY], "_place"), ORDER_KEY)
    n = df.count()

    @F.arrow_udf("array<long>")
    def targets(place: pa.Array) -> pa.Array:
        at = place.to_numpy()
        out = np.stack([permuted(at - 1, n, seed, k) + 1 for k in range(repeats)], axis=1)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * repeats, pa.int32()), pa.array(out.ravel()))

    # asked once a row and multiplied afterwards: Spark keeps the rows that wait for Python, on disk if need be
    donors = placed.withColumn("_targets", targets("_place")).select(
        F.posexplode("_targets").alias("repeat", "_place"), *[F.col(c).alias(f"donor__{c}") for c in columns])
    return placed.join(donors, "_place").drop("_place")


_BINS = "_bins"
_COUNTS = T.StructType([T.StructField("feature", T.IntegerType()), T.StructField("repeat", T.IntegerType()), T.StructField("score", T.DoubleType()),
                        T.StructField("pos", T.LongType()), T.StructField("n", T.LongType())])


def _binned(model: TreeModel, rows: DataFrame) -> DataFrame:
    """Id, label and the bin numbers of each row, all that trees see of it, as bytes."""
    spec = model.spec
    names = [ORDER_KEY, TARGET, _BINS]

    def run(batches):
        for batch in batches:
            bins = spec.bins([batch.column(2 + i) for i in range(len(spec.inputs))])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([b.tobytes() for b in bins], pa.binary())], names=names)

    schema = T.StructType([rows.schema[ORDER_KEY], rows.schema[TARGET], T.StructField(_BINS, T.BinaryType())])
    return rows.select(ORDER_KEY, TARGET, *[F.col(c).alias(f"_{c}") for c in spec.inputs]).mapInArrow(run, schema)


def _variant_counts(model: TreeModel, pairs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Positives and rows by feature, repeat and score, each row with one feature of its donor at a time; feature -1 is the row as it is.

    The variants of a batch are scored and counted where they arise: they are no rows of their own.
    """
    sent, spec = model.for_scoring(), model.spec
    used = set(model.ensemble.feature[model.ensemble.left != np.arange(len(model.ensemble.left))].tolist())
    places = []  # the bins that hang on a feature, as far as any split looks at them
    for c in columns:
        of = [spec.numeric.index(c)] if c in spec.edges else [len(spec.numeric) + spec.texts.index(c)] if c in spec.texts else []
        of += [len(spec.edges) + spec.gaps.index(c)] if c in spec.gaps else []
        places.append([p for p in of if p in used])

    def counted(feature: int, repeat: np.ndarray, score: np.ndarray, late: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((score, repeat))
        r, s = repeat[order], score[order]
        first = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (s[1:] != s[:-1])]))
        n = np.diff(np.append(first, len(r)))
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(first), feature), pa.int32()), pa.array(r[first], pa.int32()), pa.array(s[first]),
            pa.array(np.add.reduceat(late[order], first)), pa.array(n, pa.int64())], names=_COUNTS.names)

    def matrix(column: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), dtype=spec.dtype).reshape(len(column), -1)

    def run(batches):
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            if not batch.num_rows:
                continue
            late = batch.column(0).cast(pa.int64()).to_numpy()
            repeat, own, donor = batch.column(1).to_numpy(), matrix(batch.column(2)), matrix(batch.column(3))
            score = sent.probabilities(own)
            yield counted(-1, repeat, score, late)
            for feature, of in enumerate(places):
                other = np.flatnonzero((own[:, of] != donor[:, of]).any(axis=1))
                changed, variant = score.copy(), own[other]
                variant[:, of] = donor[np.ix_(other, of)]
                changed[other] = sent.probabilities(variant)
                yield counted(feature, repeat, changed, late)

    return pairs.select(TARGET, "repeat", _BINS, f"donor__{_BINS}").mapInArrow(run, _COUNTS)


def _tree_drops(model: TreeModel, rows: DataFrame, repeats: int, seed: int, columns: Sequence[str]) -> DataFrame:
    """feature and drop for each feature and repeat. Rows go to their donors as bin numbers, a byte or two a column."""
    pairs = shuffled_pairs(_binned(model, rows), repeats, seed, [_BINS])
    found = ranking_of_counts(_variant_counts(model, pairs, columns), ["feature", "repeat"]).select("feature", "repeat", "pr_auc")
    base = found.filter("feature = -1").select("repeat", F.col("pr_auc").alias("base"))
    names = F.array(*[F.lit(c) for c in columns])
    return found.filter("feature >= 0").join(base, "repeat").select(names[F.col("feature")].alias("feature"), (F.col("base") - F.col("pr_auc")).alias("drop"))


def permutation_importance(
    model: Model, rows: DataFrame, n_repeats: int = 5, seed: int = SEED,
    columns: Sequence[str] = tuple(MODEL_FEATURES),
) -> DataFrame:
    """Loss of average precision when one raw feature is shuffled: mean and deviation over repeats.

    Each row is scored once per repeat and feature, with that feature taken from its donor: all variants go
    through one pass, and all their metrics come from one grouped job.
    """
    columns = list(columns)
    drops = _tree_drops(model, rows, n_repeats, seed, columns) if isinstance(model, TreeModel) else _drops(model, rows, n_repeats, seed, columns)
    return (
        drops.groupBy("feature")
        .agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))
        .orderBy(F.desc("importance_mean"), "feature")
    )


def _drops(model: PipelineModel, rows: DataFrame, n_repeats: int, seed: int, columns: list[str]) -> DataFrame:
    base = rows.select(ORDER_KEY, TARGET, *columns)
    baseline = ranking_metrics(score_rows(model, base)).select("pr_auc").scalar()
    pairs = shuffled_pairs(base, n_repeats, seed, columns)

    def variant(c: str) -> Column:
        return F.when(F.col("feature") == c, F.col(f"donor__{c}")).otherwise(F.col(c)).alias(c)

    variants = pairs.withColumn("feature", F.explode(F.array(*[F.lit(c) for c in columns]))).select(
        "feature", "repeat", TARGET, *[variant(c) for c in columns]
    )
    return ranking_metrics(score_rows(model, variants), ["feature", "repeat"]).withColumn("drop", baseline - F.col("pr_auc"))


def tree_contributions(model: TreeModel, rows: DataFrame, key: str = ORDER_KEY) -> DataFrame:
    """key, feature and contribution in long form: each row's decision paths through all trees, by transformed feature.

    With ``path_base`` the contributions of a row add up to its raw score; features that no split uses are left out.
    """
    names = model.spec.names()
    used = [i for i, (_, gain) in enumerate(model.importances()) if gain > 0]
    sent = model.for_scoring()

    def run(batches):
        for batch in batches:
            values, _ = path_contributions(sent, sent.spec.bins([batch.column(1 + i) for i in range(len(sent.spec.inputs))]))
            for i in used:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([names[i]] * batch.num_rows, pa.string()), pa.array(values[:, i])],
                    names=[key, "feature", "contribution"])

    schema = T.StructType([rows.schema[key], T.StructField("feature", T.StringType()), T.StructField("contribution", T.DoubleType())])
    return rows.select(key, *[F.col(c).alias(f"_{c}") for c in model.spec.inputs]).mapInArrow(run, schema)


def path_base(model: TreeModel) -> float:
    """The raw score of a row before any split is looked at."""
    return path_contributions(model, np.zeros((0, len(model.spec.sizes)), dtype=model.spec.dtype))[1]


def regression_contributions(model: PipelineModel, rows: DataFrame, background: DataFrame, key: str = ORDER_KEY) -> DataFrame:
    """key, feature and contribution w * (x - mean) of a fitted regression, by transformed feature; means of ``background``.

    ``regression_base`` and the contributions of a row add up to its raw score.
    """
    names, fitted = feature_names(model), model.stages[-1]
    means = _vector_means(model, background)
    parts = F.zip_with(vector_to_array("features"), F.array(*[F.lit(m) for m in means]), lambda x, m: x - m)
    weighed = F.zip_with(parts, F.array(*[F.lit(w) for w in fitted.coefficients.toArray().tolist()]), lambda x, w: x * w)
    long = PipelineModel(model.stages[:-1]).transform(rows).select(key, F.posexplode(weighed).alias("i", "contribution"))
    return long.select(key, F.array(*[F.lit(n) for n in names])[F.col("i")].alias("feature"), "contribution")


def regression_base(model: PipelineModel, background: DataFrame) -> float:
    fitted = model.stages[-1]
    return float(fitted.intercept + np.dot(fitted.coefficients.toArray(), _vector_means(model, background)))


def _vector_means(model: PipelineModel, background: DataFrame) -> list[float]:
    vectors = PipelineModel(model.stages[:-1]).transform(background)
    return vectors.select(Summarizer.mean(F.col("features"))).first()[0].toArray().tolist()


def linear_contributions(df: DataFrame, weights: dict[str, float], key: str = ORDER_KEY) -> DataFrame:
    """Contributions w * (x - mean x) of a linear score in long form; a missing value contributes nothing."""
    means = df.agg(*[F.avg(c).alias(c) for c in weights])
    parts = F.array(*[
        F.struct(
            F.lit(c).alias("feature"),
            F.coalesce(F.lit(w) * (F.col(c).cast("double") - F.col("_means")[c]), F.lit(0.0)).alias("contribution"),
        )
        for c, w in weights.items()
    ])
    return with_scalar(df, "_means", means).select(key, F.explode(parts).alias("p")).select(key, "p.*")


def global_attribution(contributions: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature."""
    return contributions.groupBy("feature").agg(
        F.avg(F.abs("contribution")).alias("mean_absolute_contribution")
    ).orderBy(F.desc("mean_absolute_contribution"), "feature")
