"""Schedules and distillation losses over array columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def piecewise_linear(step: Column, points: list[tuple[float, float]]) -> Column:
    """Between the points in a straight line; level before the first and after the last."""
    out = F.lit(float(points[-1][1]))
    for (a, x), (b, y) in reversed(list(zip(points, points[1:], strict=False))):
        out = F.when(step < b, F.lit(float(x)) + (step - a) / F.lit(float(b - a)) * (y - x)).otherwise(out)
    return F.when(step <= points[0][0], F.lit(float(points[0][1]))).otherwise(out)


def warmup_hold_decay(step: Column, warmup: int, hold: int, decay: int, start: float, peak: float, end: float) -> Column:
    points = [(0, start), (warmup, peak), (warmup + hold, peak), (warmup + hold + decay, end)]
    return piecewise_linear(step, [p for i, p in enumerate(points) if not i or p[0] > points[i - 1][0]])


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine_loss(a: Column, b: Column) -> Column:
    return 1 - dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def let(value: Column, then) -> Column:
    """then(value), with the value worked out once: lambdas work out what they hold for each element."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def log_total(x: Column) -> Column:
    """Logarithm of the sum of exponentials."""
    return let(F.array_max(x).cast("double"), lambda top: top + F.log(F.aggregate(x, F.lit(0.0), lambda s, v: s + F.exp(v.cast("double") - top))))


def log_softmax(x: Column) -> Column:
    return let(log_total(x), lambda z: F.transform(x, lambda v: v.cast("double") - z))


def top_k(x: Column, k: int) -> Column:
    """The k largest values with their places, largest first; of equals the later place first."""
    return F.slice(F.sort_array(F.transform(x, lambda v, i: F.struct(v.cast("double").alias("v"), i.alias("i"))), asc=False), 1, k)


def _kl(log_p: Column, log_q: Column) -> Column:
    return F.aggregate(F.zip_with(log_p, log_q, lambda a, b: F.exp(a) * (a - b)), F.lit(0.0), lambda s, x: s + x)


def renormalized_top_k_kl(teacher: Column, student: Column, k: int) -> Column:
    """KL of the student from the teacher, both softmaxed over the teacher's k largest logits."""
    pairs = lambda top: F.transform(top, lambda t: F.struct(t["v"].alias("t"), F.get(student, t["i"]).alias("s")))
    return let(let(top_k(teacher, k), pairs), lambda p: _kl(log_softmax(p["t"]), log_softmax(p["s"])))


def masked_mean(value: Column, mask: Column) -> Column:
    return F.sum(value * mask) / F.greatest(F.sum(mask), F.lit(1))


def normalized_mse(teacher: Column, student: Column) -> Column:
    """Squared distance by the teacher's squared length."""
    gap = F.zip_with(teacher, student, lambda x, y: x.cast("double") - y.cast("double"))
    return dot(gap, gap) / F.greatest(dot(teacher, teacher), F.lit(1e-12))


def unit_mse(teacher: Column, student: Column) -> Column:
    """Mean squared difference of the two vectors at length one; a vector of length 0 stays as it is."""
    unit = lambda x: let(F.greatest(F.sqrt(dot(x, x)), F.lit(1e-12)), lambda n: F.transform(x, lambda v: v.cast("double") / n))
    gap = F.zip_with(unit(teacher), unit(student), lambda a, b: a - b)
    return let(gap, lambda g: dot(g, g) / F.size(g))


def bounded_cosine_loss(teacher: Column, student: Column) -> Column:
    """1 less the cosine; lengths below 1e-8 count as that, so a vector of length 0 has loss 1."""
    size = lambda x: F.greatest(F.sqrt(dot(x, x)), F.lit(1e-8))
    return 1 - dot(teacher, student) / (size(teacher) * size(student))


HIDDEN = {"normalized_mse": unit_mse, "cosine": bounded_cosine_loss}


def hidden_loss(student: DataFrame, teacher: DataFrame, layers: Sequence[tuple[int, int]], mask: DataFrame, kind: str, token: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """by, loss: the mean over mapped layers of the masked mean over tokens of the loss between hidden vectors.

    student and teacher: token columns, layer and hidden; mask: token columns and mask; layers: pairs of a student's and a
    teacher's layer, of which each counts, repeated ones too. by: columns of the token. Tokens without a mask count as
    masked; a layer of which no token has both vectors is an error, as it would be left out of the mean unnoticed.
    """
    if kind not in HIDDEN:
        raise ValueError(f"no hidden loss {kind}; there are {', '.join(HIDDEN)}")
    if not layers:
        raise ValueError("at least one pair of layers has to be mapped")
    spark = student.sparkSession
    pairs = F.broadcast(spark.createDataFrame([(k, *map(int, x)) for k, x in enumerate(layers)], "entry int, student_layer int, teacher_layer int"))
    own = student.select(*token, F.col("layer").alias("student_layer"), F.col("hidden").alias("student_hidden")).join(pairs, "student_layer")
    other = teacher.select(*token, F.col("layer").alias("teacher_layer"), F.col("hidden").alias("teacher_hidden"))
    both = own.join(other, [*token, "teacher_layer"]).join(mask.select(*token, "mask"), list(token), "left")
    weight = F.coalesce(F.col("mask").cast("double"), F.lit(0.0))
    each = both.select("entry", *by, HIDDEN[kind](F.col("teacher_hidden"), F.col("student_hidden")).alias("value"), weight.alias("weight"))
    means = each.groupBy("entry", *by).agg(masked_mean(F.col("value"), F.col("weight")).alias("mean"))
    out = means.groupBy(*by).agg(F.avg("mean").alias("loss"), F.count(F.lit(1)).alias("n"))
    lacking = F.raise_error(F.concat(F.lit("mapped layers without a token: "), (F.lit(len(layers)) - F.col("n")).cast("string"))).cast("double")
    return out.select(*by, F.when(F.col("n") < len(layers), lacking).otherwise(F.col("loss")).alias("loss"))


def truncated_top_k_kl(teacher: Column, student: Column, k: int) -> Column:
    """KL over the teacher's k largest logits, both sides by their full denominators."""
    totals = F.struct(log_total(teacher).alias("t"), log_total(student).alias("s"), top_k(teacher, k).alias("top"))

    def summed(z: Column) -> Column:
        return F.aggregate(z["top"], F.lit(0.0), lambda s, x: s + F.exp(x["v"] - z["t"]) * (x["v"] - z["t"] - F.get(student, x["i"]).cast("double") + z["s"]))

    return let(totals, summed)


def schedule(step: Column, kind: str, **how) -> Column:
    """constant (value), piecewise_linear (points), warmup_constant (warmup, start, peak) or warmup_hold_decay; steps below 0 fail."""
    made = {
        "constant": lambda value: F.lit(float(value)),
        "piecewise_linear": lambda points: piecewise_linear(step, points),
        "warmup_constant": lambda warmup, start, peak: piecewise_linear(step, [(0, start), (warmup, peak)] if warmup else [(0, peak)]),
        "warmup_hold_decay": lambda **k: warmup_hold_decay(step, **k),
    }
    if kind not in made:
        raise ValueError(f"no schedule {kind}")
    return F.when(step < 0, F.raise_error(F.lit("a step can't be negative")).cast("double")).otherwise(made[kind](**how))


def total_loss(raw: dict[str, Column], weight: dict[str, Column]) -> Column:
    """Raw losses by their weights, as a struct: loss, and of each part its raw and weighted loss and its weight.

    A part whose weight is 0 counts as 0, whatever its loss."""
    fields, total = [], F.lit(0.0)
    for name, w in weight.items():
        part = F.when(w == 0, F.lit(0.0)).otherwise(raw[name])
        total = total + part * w
        fields += [part.alias(f"loss_{name}_raw"), (part * w).alias(f"loss_{name}_weighted"), w.alias(f"lambda_{name}")]
    return F.struct(total.alias("loss"), *fields)


def validation_loss(df, by: list[str], rank: str, value: str = "loss"):
    """The mean over ranks of each rank's mean over its batches."""
    return df.groupBy(*by, rank).agg(F.avg(value).alias("mean")).groupBy(*by).agg(F.avg("mean").alias(value))


def reduced_metrics(df, by: list[str], rank: str, name: str = "metric", value: str = "value"):
    """One value of each metric: sums within a rank and the mean over ranks for losses, the mean for others that differ, else the value that all have."""
    within = df.groupBy(*by, name, rank).agg(F.sum(value).alias("total"), F.avg(value).alias("mean"), F.min(value).alias("low"), F.max(value).alias("high"), F.count("*").alias("n"))
    over = within.groupBy(*by, name).agg(F.avg("total").alias("sums"), (F.sum(F.col("mean") * F.col("n")) / F.sum("n")).alias("mean"), F.min("low").alias("low"), F.max("high").alias("high"))
    pick = F.when(F.col(name).contains("loss"), F.col("sums")).when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.col("mean"))
    return over.select(*by, name, pick.alias(value))


def shifted_mask(mask: Column, length: Column) -> Column:
    """A response mask for logits that predict the next token: its first place goes if it is one longer."""
    return F.when(F.size(mask) == length + 1, F.slice(mask, F.lit(2), length)).otherwise(mask)
