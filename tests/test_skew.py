"""Hot keys: one accident owns most injured rows, one corridor owns most accidents.

AQE's skew thresholds are lowered so skewed-partition handling is exercised; the feature
plans must still give exact totals, equal to the five-query form.
"""
import datetime as dt

from pyspark.sql import functions as F

from roadrisk.operators import aggregates as A
from roadrisk.plans.features import build_features_from


def test_hot_accident_and_hot_corridor(spark):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        d = dt.date(2020, 6, 1)
        n_acc, hot_injured = 3000, 20000
        # 90% of the accidents on corridor CIV 1; accident A0 holds hot_injured injured rows.
        acc = spark.range(n_acc).select(
            F.format_string("A%09d", "id").alias("FORMULARIO"),
            F.when(F.col("id") % 10 == 0, (F.col("id") % 7 + 2).cast("int")).otherwise(F.lit(1)).alias("CIV"),
            F.lit(d).alias("FECHA_ACC"), F.lit("LUNES").alias("DIA_OCURRENCIA_ACC"),
            (F.col("id") % 24).cast("int").alias("HORA_OCURRENCIA_ACC"),
            F.when(F.col("id") % 3 == 0, F.lit("CON MUERTOS")).otherwise(F.lit("CON HERIDOS")).alias("GRAVEDAD"))
        hot = spark.range(hot_injured).select(F.lit("A000000000").alias("FORMULARIO"),
                                              F.lit("PEATON").alias("CONDICION"))
        rest = spark.range(n_acc).select(F.format_string("A%09d", "id").alias("FORMULARIO"),
                                         F.lit("CONDUCTOR").alias("CONDICION"))
        injured = hot.unionByName(rest)
        killed = spark.range(0, n_acc, 3).select(F.format_string("A%09d", "id").alias("FORMULARIO"),
                                                 F.lit("CICLISTA").alias("CONDICION"))
        grid = spark.range(1, 9).select(F.col("id").alias("pos"), F.col("id").cast("int").alias("CIV"),
                                        F.concat(F.lit("AV "), F.col("id").cast("string")).alias("MVINOMBRE"))
        out = build_features_from(acc, injured, killed, grid, "2020-12-31")
        tot = out.agg(*[F.sum(c).alias(c) for c in A.MEASURES]).collect()[0]
        # A0 is fatal (id % 3 == 0): its injured count once (CON MUERTOS with killed rows).
        assert tot.accidentes == n_acc and tot.muertes == n_acc // 3
        assert tot.heridos == hot_injured + n_acc
        assert tot.heridos_vulnerables == hot_injured
        assert tot.muertes_vulnerables == n_acc // 3
        # same cells as the reference-shaped five-query form
        a1 = A.accident_counts(acc, "2020-12-31")
        five = A.join_features(a1, A.injured_counts(acc, injured, "2020-12-31"),
                               A.fatal_counts(acc, killed, injured, "2020-12-31"),
                               A.injured_counts(acc, injured, "2020-12-31", vulnerable=True),
                               A.fatal_counts(acc, killed, injured, "2020-12-31", vulnerable=True), grid)
        a6 = five.groupBy("MVINOMBRE", A.DIA, A.HORA).agg(*A._sums())
        ref = A.corridor_block_totals(A.corridor_day_block_totals(a6))
        assert sorted(map(tuple, out.collect())) == sorted(map(tuple, ref.select(*out.columns).collect()))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
