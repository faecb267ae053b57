"""Problem 4: consensus labels, agreement and reliability of annotators.

A label is right with probability sigmoid(ability * ease), ability of the coder in the field and ease of the window in it; wrong ones
are equally likely. Expectation-maximisation: given the abilities, a window's label posterior and its ease follow from the
window's own labels; given those, every ability takes a damped gradient step, until abilities stay. The labels are shuffled once, to one
row per window and field; from round to round only sums per coder and field travel.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.ontology import VALUES, long_labels
from corpuscle.operators.agreement import alpha
from corpuscle.session import settle
from corpuscle.sources.tables import current_rows, table

FIELDS = ["function", "loop", "density", "evidence_type"]
#: Abilities have settled when no step moves one by SETTLED; more rounds than MOST_ROUNDS are an error.
SETTLED, MOST_ROUNDS = 0.02, 200
#: Normal priors: abilities around MEAN, log ease around 0.
MEAN, ABILITY_VAR, EASE_VAR = 1.0, 2.0, 0.5
#: Labels without looking reach a chance-corrected agreement of this many standard errors above 0 once in a hundred times.
CHANCE_ERRORS = 2.326
#: Up to so many abilities are broadcast (at most some 20 MB); more are joined to the labels.
MOST_BROADCAST = 200_000

_ITEMS = "field string, item string, labels array<struct<coder:string,label:int,a:double>>"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Rows:
    """The labels of a batch of items, laid end to end: item, coder, label, ability; posteriors and eases of the items."""

    def __init__(self, batch: pa.RecordBatch, shared):
        self.fields = batch.column(0)
        labels = batch.column(2)
        flat = labels.flatten()
        self.size = np.diff(labels.offsets.to_numpy())
        self.item = np.repeat(np.arange(batch.num_rows), self.size)
        self.coder, self.label = flat.field(0), flat.field(1).to_numpy(zero_copy_only=False)
        self.field = self.fields.take(pa.array(self.item))
        if shared is None:
            self.a = flat.field(2).to_numpy(zero_copy_only=False)
        else:
            names, values = shared.value
            self.a = values[pc.index_in(pc.binary_join_element_wise(self.field, self.coder, "\x00"), value_set=pa.array(names, pa.string())).to_numpy(zero_copy_only=False)]
        self.k = np.array([len(VALUES[f]) for f in self.fields.to_pylist()], float)
        self.most = int(self.k.max(initial=1))
        self.open = np.arange(self.most) < self.k[:, None]
        first = self._posterior(np.ones(batch.num_rows))
        q = _sigmoid(self.a)
        slope = np.bincount(self.item, (first - q) * self.a, batch.num_rows)
        curve = np.bincount(self.item, q * (1 - q) * self.a**2, batch.num_rows) + 1 / EASE_VAR
        self.ease = np.exp(np.clip(slope / curve, -1, 1))
        self.p = self._posterior(self.ease)

    def _posterior(self, ease: np.ndarray) -> np.ndarray:
        """Probability that the row's label is the item's; leaves the items' weights of all labels behind."""
        n = len(ease)
        self.d = self.a * ease[self.item] + np.log(self.k[self.item] - 1)
        score = np.bincount(self.item * self.most + self.label, self.d, n * self.most).reshape(n, self.most)
        self.top = score.max(1, initial=0)
        self.weight = np.where(self.open, np.exp(score - self.top[:, None]), 0.0)
        self.total = self.weight.sum(1)
        return self.weight[self.item, self.label] / self.total[self.item]

    def by_coder(self, **columns: np.ndarray) -> pa.RecordBatch:
        """Sums of columns by field and coder."""
        t = pa.table({"field": self.field, "coder": self.coder, **{k: pa.array(v) for k, v in columns.items()}})
        out = t.group_by(["field", "coder"]).aggregate([(k, "sum") for k in columns])
        return out.rename_columns(["field", "coder", *columns]).combine_chunks().to_batches()


def _over(items: DataFrame, abilities: DataFrame, made, schema: str) -> DataFrame:
    """``made`` (of Rows) over all items, with the abilities looked up; they are joined where there are too many to broadcast."""
    few = abilities.limit(MOST_BROADCAST + 1).collect()
    if len(few) <= MOST_BROADCAST:
        shared = items.sparkSession.sparkContext.broadcast(([f"{r.field}\x00{r.coder}" for r in few], np.array([r._a for r in few], float)))
    else:
        shared = None
        one = items.select("field", "item", F.explode("labels").alias("_l")).select("field", "item", "_l.coder", "_l.label").join(abilities, ["field", "coder"])
        items = one.groupBy("field", "item").agg(F.collect_list(F.struct("coder", "label", F.col("_a").alias("a"))).alias("labels"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from made(Rows(batch, shared), batch)

    return items.select("field", "item", "labels").mapInArrow(run, schema)


def _gradients(r: Rows, _: pa.RecordBatch) -> list[pa.RecordBatch]:
    e = r.ease[r.item]
    q = _sigmoid(r.a * e)
    return r.by_coder(g=(r.p - q) * e, h=q * (1 - q) * e * e)


def fit(labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items with their labels in one row, abilities) of ``labels`` (field, item, coder, label).

    An item has one label a coder, so its row is no larger than there are coders.
    """
    code = F.coalesce(*[F.when(F.col("field") == f, F.array_position(F.array(*map(F.lit, VALUES[f])), F.col("label")).cast("int") - 1) for f in FIELDS])
    one = F.struct("coder", code.alias("label"), F.lit(MEAN).alias("a"))
    items = settle(labels.groupBy("field", "item").agg(F.array_sort(F.collect_list(one)).alias("labels")))
    abilities = settle(items.select("field", F.explode("labels.coder").alias("coder")).distinct().withColumn("_a", F.lit(MEAN)))
    for _ in range(MOST_ROUNDS):
        sums = _over(items, abilities, _gradients, "field string, coder string, g double, h double").groupBy("field", "coder").agg(F.sum("g").alias("_g"), F.sum("h").alias("_h"))
        slope = F.col("_g") - (F.col("_a") - F.lit(MEAN)) / F.lit(ABILITY_VAR)
        step = F.greatest(F.least(slope / (F.col("_h") + F.lit(1.0 / ABILITY_VAR)), F.lit(1.5)), F.lit(-1.5))
        abilities = settle(sums.join(abilities, ["field", "coder"]).select("field", "coder", (F.col("_a") + step).alias("_a"), F.abs(step).alias("_step")))
        if (abilities.agg(F.max("_step").alias("m")).first().m or 0.0) < SETTLED:
            return items, abilities.drop("_step")
        abilities = abilities.drop("_step")
    raise ValueError("abilities don't settle")


def labels_of(annotations: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """field, item, coder, label: a coder's last valid label of a window in each field, over all rounds.

    ``annotations``: round, coder, window_id, annotated_at and the fields. Other spellings are the same label, values outside the
    vocabulary none. Rows without coder or window are left out.
    """
    fields = fields or FIELDS
    # By window from the start, so that everything up to the items' rows needs no other shuffle; a window has one row per coder and round.
    own = annotations.select("round", "coder", "window_id", "annotated_at", *sorted({*fields, "function"})).where("coder is not null and window_id is not null")
    rows = current_rows(own.repartition("window_id"), ["round", "coder", "window_id"], "annotated_at")
    long = long_labels(rows, ["round", "coder", "window_id", "annotated_at"], fields)
    one = long.groupBy("field", F.col("window_id").alias("item"), "coder").agg(F.max(F.struct("annotated_at", "round", "label"))["label"].alias("label"))
    return one


def _agreements(r: Rows, _: pa.RecordBatch) -> list[pa.RecordBatch]:
    """By coder: labels, agreement with the others' posterior, and by label the others' posterior and the coder's own labels."""
    i, own = r.item, r.label
    # Without the row's own label its item's weight of that label is smaller by exp(d).
    weight = r.weight[i].copy()
    at = np.arange(len(i))
    weight[at, own] *= np.exp(-r.d)
    rest = weight / weight.sum(1, keepdims=True)
    some = (r.size[i] > 1).astype(float)
    mine = np.zeros_like(rest)
    mine[at, own] = 1
    columns = {"n": some, "s": rest[at, own] * some}
    for x in range(MOST_LABELS):
        columns[f"p{x}"] = rest[:, x] * some if x < r.most else np.zeros(len(i))
        columns[f"q{x}"] = mine[:, x] * some if x < r.most else np.zeros(len(i))
    return r.by_coder(**columns)


MOST_LABELS = max(len(VALUES[f]) for f in FIELDS)


def reliability(annotations: DataFrame) -> DataFrame:
    """field, coder, ``n_labels``, ``ability``, ``agreement``, ``by_chance``, ``corrected``, ``chance_limit``.

    ``agreement`` is the mean posterior, by the other coders of the window alone, of the coder's own labels; ``by_chance`` what it
    would be if the coder gave the same labels without looking at the window; ``corrected`` their difference against the most
    possible, 0 where chance alone agrees always. ``chance_limit``: how far so many labels without looking may lie above 0, by the
    standard error of ``corrected``. Windows without another coder's label don't count; a coder of only such windows has no row.
    """
    items, abilities = fit(labels_of(annotations))
    names = [f"{c}{x}" for c in "pq" for x in range(MOST_LABELS)]
    sums = ["n", "s", *[f"{c}{x}" for x in range(MOST_LABELS) for c in "pq"]]
    made = _over(items, abilities, _agreements, "field string, coder string, " + ", ".join(f"{c} double" for c in sums))
    out = made.groupBy("field", "coder").agg(*[F.sum(c).alias(c) for c in ["n", "s", *names]]).where("n > 0")
    both = sum((F.col(f"p{x}") * F.col(f"q{x}") for x in range(MOST_LABELS)), F.lit(0.0))
    out = out.select("field", "coder", F.col("n").cast("bigint").alias("n_labels"), (F.col("s") / F.col("n")).alias("agreement"), (both / (F.col("n") * F.col("n"))).alias("by_chance"))
    room = F.lit(1.0) - F.col("by_chance")
    out = out.withColumn("corrected", F.when(room > 1e-9, (F.col("agreement") - F.col("by_chance")) / room).otherwise(F.lit(0.0)))
    out = out.withColumn("chance_limit", F.when(room > 1e-9, F.lit(CHANCE_ERRORS) * F.sqrt(F.col("by_chance") / (F.col("n_labels") * room))).otherwise(F.lit(0.0)))
    return out.join(abilities.withColumnRenamed("_a", "ability"), ["field", "coder"])


def _labelled(r: Rows, batch: pa.RecordBatch) -> list[pa.RecordBatch]:
    fields = r.fields.to_pylist()
    p = np.round(r.weight / r.total[:, None], 12)
    given = np.bincount(r.item * r.most + r.label, minlength=len(fields) * r.most).reshape(p.shape) > 0
    # The most probable of the labels given; of equal ones the least by name.
    best = []
    for f, row, seen in zip(fields, p, given):
        names = VALUES[f]
        best.append(min((-row[j], names[j], j) for j in np.flatnonzero(seen))[1:])
    return [pa.RecordBatch.from_arrays([batch.column(1), r.fields, pa.array([x[0] for x in best], pa.string()), pa.array([p[i, x[1]] for i, x in enumerate(best)], pa.float64()), pa.array(r.ease, pa.float64()), pa.array(r.size, pa.int64())], names=["window_id", "field", "label", "posterior", "ease", "n_coders"])]


def consensus(annotations: DataFrame) -> DataFrame:
    """window_id, field, ``label`` (the most probable of those given, the least by name of equals), ``posterior``, ``ease``, ``n_coders``."""
    items, abilities = fit(labels_of(annotations))
    return _over(items, abilities, _labelled, "window_id string, field string, label string, posterior double, ease double, n_coders bigint")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reliability(table(spark, sf_dir, "annotations")).where(F.col("corrected") <= F.col("chance_limit")).select("coder", "field")


def p4_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reliability(table(spark, sf_dir, "annotations"))


def p4_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consensus(table(spark, sf_dir, "annotations"))


def p4_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Krippendorff's alpha of each field."""
    labels = settle(labels_of(table(spark, sf_dir, "annotations")))
    nominal = alpha(labels.where("field <> 'density'"), ["field"], "item", "coder", "label", "nominal")
    ordinal = alpha(labels.where("field = 'density'"), ["field"], "item", "coder", "label", "ordinal")
    return nominal.unionByName(ordinal).withColumn("alpha", F.round("alpha", 6))


def _agreement_sql() -> str:
    """Krippendorff's alpha of the last valid label of each coder and window, nominal, ordinal for density."""
    normal = lambda f: f"lower(regexp_replace(CAST({f} AS VARCHAR), '^\\s+|\\s+$', '', 'g'))"
    listed = lambda f: "(" + ", ".join(f"'{v}'" for v in VALUES[f]) + ")"
    parts = [f"SELECT \"round\", coder, window_id, annotated_at, '{f}' AS field, {normal(f)} AS label FROM ca WHERE {normal(f)} IN {listed(f)}" + (f" AND {normal('function')} = 'evidence'" if f == "evidence_type" else "") for f in FIELDS]
    return f"""WITH ca AS (SELECT * FROM annotations WHERE coder IS NOT NULL AND window_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY "round", coder, window_id ORDER BY annotated_at DESC NULLS LAST) = 1),
      long AS ({" UNION ALL ".join(parts)}),
      r AS (SELECT * FROM long QUALIFY row_number() OVER (PARTITION BY field, coder, window_id ORDER BY annotated_at DESC NULLS LAST, "round" DESC NULLS LAST, label DESC) = 1),
      e AS (SELECT *, count(*) OVER (PARTITION BY field, window_id) AS m FROM r QUALIFY m >= 2),
      mg0 AS (SELECT field, label, CAST(count(*) AS DOUBLE) AS n FROM e GROUP BY 1, 2), mg AS (SELECT *, sum(n) OVER (PARTITION BY field ORDER BY label) - n / 2.0::DOUBLE AS s FROM mg0),
      pr AS (SELECT a.field, a.m, CASE WHEN a.field = 'density' THEN (ma.s - mb.s) * (ma.s - mb.s) WHEN a.label = b.label THEN 0::DOUBLE ELSE 1::DOUBLE END AS d FROM e a JOIN e b ON a.field = b.field AND a.window_id = b.window_id AND a.coder <> b.coder
        JOIN mg ma ON ma.field = a.field AND ma.label = a.label JOIN mg mb ON mb.field = b.field AND mb.label = b.label),
      ob AS (SELECT field, sum(d / (m - 1)) AS o FROM pr GROUP BY 1),
      ex AS (SELECT a.field, sum(a.n * b.n * CASE WHEN a.field = 'density' THEN (a.s - b.s) * (a.s - b.s) WHEN a.label = b.label THEN 0::DOUBLE ELSE 1::DOUBLE END) AS x FROM mg a JOIN mg b ON a.field = b.field GROUP BY 1),
      tt AS (SELECT field, CAST(count(*) AS DOUBLE) AS t, count(DISTINCT window_id) AS n_units, count(DISTINCT label) AS k FROM e GROUP BY 1)
      SELECT field, CASE WHEN k >= 2 THEN round(1 - (o / t) / (x / (t * (t - 1))), 6) END AS alpha, n_units, CAST(t AS BIGINT) AS n_ratings FROM tt JOIN ob USING (field) JOIN ex USING (field)"""


QUERIES = {"p4_found": p4_found, "p4_reliability": p4_reliability, "p4_consensus": p4_consensus, "p4_agreement": p4_agreement}
SQL = {"p4_agreement": _agreement_sql()}
