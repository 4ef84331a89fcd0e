"""Training table and feature vectors."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import ElementwiseProduct, Interaction, OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stayline.operators.facts import attach_facts, keep_players
from stayline.operators.prefix import running_sums
from stayline.session import durable

# The order of the features.
FEATURES = ("area_feature", "gender_feature", "song_nums", "delta_time")
CATEGORIES = ("area", "gender")
NUMBERS = ("song_nums", "delta_time")


def feature_table(
    facts: DataFrame,
    grain: str = "user",
    log: DataFrame | None = None,
    zero_plays: str = "drop",
    small: bool = False,
) -> DataFrame:
    """gender, area, delta_time, song_nums and label per user, with the user id
    for the split and the user's events as ``weight``.

    ``grain="event"`` repeats a user's row for each of its events in ``log``.
    Training on that equals training on user rows weighted by ``weight``, which
    is how :func:`stayline.operators.models.prepare` offers it.
    """
    users = keep_players(facts, zero_plays).select(
        "userId",
        "gender",
        "area",
        "delta_time",
        "song_nums",
        F.col("churn_users").alias("label"),
        F.col("n_events").alias("weight"),
    )
    if grain == "user":
        return users
    if grain != "event" or log is None:
        raise ValueError("grain is 'user', or 'event' with a log")
    columns = [c for c in users.columns if c not in ("userId", "weight")]
    return attach_facts(log.select("userId"), users, columns, small=small)


def incomplete_rows(features: DataFrame) -> DataFrame:
    """How many rows lack a number, in all and by column; vectors can't be made of them."""
    missing = [F.col(c).isNull() for c in NUMBERS]
    return features.agg(
        F.count("*").alias("n_rows"),
        F.count_if(missing[0] | missing[1]).alias("n_incomplete"),
        *[F.count_if(m).alias(f"null_{c}") for c, m in zip(NUMBERS, missing)],
    )


def complete_rows(features: DataFrame) -> DataFrame:
    """Rows with all numbers; :func:`incomplete_rows` counts the others."""
    return features.where(F.col(NUMBERS[0]).isNotNull() & F.col(NUMBERS[1]).isNotNull())


def label_index(rows: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """(value, index, n) of a column's values, the most frequent first, equal ones in order.

    The table is stored and stays a table, however many values there are. Ranks are running sums
    over range-sorted parts, as many as the values ask for, so no task ranks all values.
    """
    n = F.sum(weight) if weight else F.count("*")
    counts = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
    less = (-F.col("n")).alias("less")
    counted = counts.agg(n.cast("double").alias("n")).select(
        "value", "n", F.struct(less, "value").alias("rank"), F.lit(1).alias("one")
    )
    ranked = running_sums(durable(counted), [], "rank", ["one"])
    return durable(ranked.select("value", F.col("one_before").cast("double").alias("index"), "n"))


def _scale_of(variance: float) -> float:
    return variance**-0.5 if variance > 0 else 0.0


@dataclass
class FeatureModel:
    """Index tables, and what features are scaled by; learned from training rows only.

    With one-hot slots the scale of a label stands in its index table (``scale``), so nothing on
    the driver grows with the labels: it holds the scales of unseen labels and of the numbers.
    """

    indexes: dict[str, DataFrame]
    sizes: dict[str, int]
    encode: str
    scale: ElementwiseProduct | None = None
    scales: dict[str, float] = field(default_factory=dict)

    @property
    def max_bins(self) -> int:
        """What a tree needs to take the indexes as categories: unseen is one of them."""
        return max(n + 1 for n in self.sizes.values())

    def indexed(self, df: DataFrame) -> DataFrame:
        """``df`` with ``<category>_feature``, and with one-hot slots ``<category>_scale``.

        Unseen and missing values share the index after the last.
        """
        for c, index in self.indexes.items():
            n = self.sizes[c]
            kind = {"type": "nominal", "name": f"{c}_feature", "num_vals": n + 1}
            found = index.select(
                F.col("value").alias("_value"), F.struct(*index.columns).alias("_found")
            )
            added = {f"{c}_feature": F.coalesce("_found.index", F.lit(float(n)))}
            if c in self.scales:
                added[f"{c}_scale"] = F.coalesce("_found.scale", F.lit(self.scales[c]))
            df = df.join(found, F.col(c) == F.col("_value"), "left").withColumns(added)
            df = df.drop("_value", "_found").withMetadata(f"{c}_feature", {"ml_attr": kind})
        return df

    def assemble(self, df: DataFrame) -> DataFrame:
        """``df`` with an index for each category, and all features in ``features1``.

        A missing number is an error.
        """
        df = self.indexed(df)
        inputs = list(FEATURES)
        if self.encode == "onehot":
            inputs[:2] = ["area_slots", "gender_slots"]
            encoder = OneHotEncoder(inputCols=list(FEATURES[:2]), outputCols=inputs[:2], dropLast=False)
            df = encoder.fit(df).transform(df)  # sizes come from the columns' metadata
        return VectorAssembler(inputCols=inputs, outputCol="features1").transform(df)

    def transform(self, df: DataFrame) -> DataFrame:
        df = self.assemble(df)
        if self.encode == "index":
            return self.scale.transform(df)
        inputs = []
        for c in CATEGORIES:
            product = Interaction(inputCols=[f"{c}_scale", f"{c}_slots"], outputCol=f"_{c}_scaled")
            df = product.transform(df)
            inputs.append(f"_{c}_scaled")
        df = df.withColumns({f"_{c}_scaled": F.col(c) * self.scales[c] for c in NUMBERS})
        inputs += [f"_{c}_scaled" for c in NUMBERS]
        return VectorAssembler(inputCols=inputs, outputCol="features").transform(df).drop(*inputs)

    def scaled_slots(self, df: DataFrame) -> DataFrame:
        """(userId, slot, value) of the scaled one-hot slots that aren't 0, made by joins alone.

        No vector of all slots exists anywhere, so the labels may be as many as a table can hold.
        A missing number has no slot.
        """
        if self.encode != "onehot":
            raise ValueError("the model has no one-hot slots")
        first, slots = 0, []
        for c in CATEGORIES:
            slot = (F.col(f"{c}_feature") + first).cast("long")
            slots.append(F.struct(slot.alias("slot"), F.col(f"{c}_scale").alias("value")))
            first += self.sizes[c] + 1
        for place, c in enumerate(NUMBERS, first):
            value = (F.col(c) * self.scales[c]).alias("value")
            slots.append(F.struct(F.lit(place).cast("long").alias("slot"), value))
        return self.indexed(df).select("userId", F.inline(F.array(*slots))).where("value <> 0")

    def save(self, path: str) -> None:
        """Write the model under ``path``: a table for each index, and one row for the rest."""
        for c, index in self.indexes.items():
            index.write.parquet(f"{path}/{c}")
        spark = index.sparkSession
        vector = list(self.scale.getScalingVec().toArray()) if self.scale else []
        row = (list(FEATURES), self.encode, self.sizes, [float(v) for v in vector], self.scales)
        spark.createDataFrame([row], MODEL_SCHEMA).write.parquet(f"{path}/model")


MODEL_SCHEMA = (
    "features array<string>, encode string, sizes map<string,long>, scale array<double>,"
    " scales map<string,double>"
)


def load_features(spark: SparkSession, path: str) -> FeatureModel:
    """A model that :meth:`FeatureModel.save` wrote; an error if its features are not today's."""
    row = spark.read.schema(MODEL_SCHEMA).parquet(f"{path}/model").first()
    if tuple(row.features) != FEATURES:
        raise ValueError(f"the stored model has the features {row.features}")
    indexes = {c: spark.read.parquet(f"{path}/{c}") for c in CATEGORIES}
    model = FeatureModel(indexes, row.sizes, row.encode, scales=row.scales)
    if row.encode == "index":
        model.scale = _product(row.scale)
    return model


def _product(scale: list[float]) -> ElementwiseProduct:
    return ElementwiseProduct(
        inputCol="features1", outputCol="features", scalingVec=Vectors.dense(scale)
    )


def _variances(rows: DataFrame, vector: str, weight: Column) -> tuple[list[float], float]:
    """Variance of each slot of a vector, a row counting ``weight`` times; and the rows so counted."""
    stats = rows.agg(
        Summarizer.variance(F.col(vector), weight).alias("variance"),
        F.sum(weight).alias("w"),
        F.sum(weight * weight).alias("w2"),
    ).first()
    if not stats.w:
        return [], 0.0
    # The summarizer takes weights for reliabilities; as counts they have one degree less.
    unbiased = (stats.w - stats.w2 / stats.w) / (stats.w - 1) if stats.w > 1 else 0.0
    return [float(v) * unbiased for v in stats.variance], stats.w


def fit_features(
    train: DataFrame, encode: str = "index", weight: str | None = None
) -> FeatureModel:
    """Learn indexes and scales from training rows.

    ``weight`` is a column of whole numbers: a row counts as if it stood there so many times, for
    the order of the labels and for the deviations. ``encode="onehot"`` spreads the indexes over
    0/1 slots, for linear models, to which an index is no quantity.
    """
    if encode not in ("index", "onehot"):
        raise ValueError("encode is 'index' or 'onehot'")
    indexes = {c: label_index(train, c, weight) for c in CATEGORIES}
    sizes = {c: index.count() for c, index in indexes.items()}
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    if encode == "index":
        model = FeatureModel(indexes, sizes, encode)
        variances, _ = _variances(model.assemble(train), "features1", w)
        model.scale = _product([_scale_of(v) for v in variances] or [0.0] * len(FEATURES))
        return model
    numbers = VectorAssembler(inputCols=list(NUMBERS), outputCol="_numbers").transform(train)
    variances, total = _variances(numbers, "_numbers", w)
    scales = dict(zip(NUMBERS, [_scale_of(v) for v in variances] or [0.0] * len(NUMBERS)))
    for c in CATEGORIES:
        # A 0/1 slot that n of all rows have: its deviation follows from the two numbers.
        known = indexes[c].agg(F.sum("n")).first()[0] or 0.0
        rest = total - known
        scales[c] = _scale_of((rest - rest * rest / total) / (total - 1)) if total > 1 else 0.0
        variance = (F.col("n") - F.col("n") * F.col("n") / total) / (total - 1) if total > 1 else F.lit(0.0)
        scale = F.when(variance > 0, 1 / F.sqrt(variance)).otherwise(0.0)
        indexes[c] = indexes[c].withColumn("scale", scale)
    return FeatureModel(indexes, sizes, encode, scales=scales)


def linear_scores(
    df: DataFrame, coefficients: list[float] | tuple[float, ...], intercept: float, vector: str = "features"
) -> DataFrame:
    """``df`` with ``margin`` and ``probability`` of a linear model given by its coefficients."""
    weights = F.array(*[F.lit(float(c)) for c in coefficients])
    products = F.zip_with(vector_to_array(vector), weights, lambda x, c: x * c)
    margin = F.aggregate(products, F.lit(float(intercept)), lambda total, x: total + x)
    return df.withColumn("margin", margin).withColumn("probability", 1 / (1 + F.exp(-F.col("margin"))))


def vector_columns(df: DataFrame, vector: str) -> DataFrame:
    """User id and the slots of an index-encoded vector as plain columns."""
    slots = df.withColumn("slots", vector_to_array(vector))
    return slots.select(
        "userId", *[F.col("slots")[i].alias(name) for i, name in enumerate(FEATURES)]
    )


def vector_slots(df: DataFrame, vector: str) -> DataFrame:
    """(userId, slot, value) of all slots of a vector that aren't 0."""
    slots = df.select("userId", F.posexplode(vector_to_array(vector)).alias("slot", "value"))
    return slots.where(F.col("value") != 0)
