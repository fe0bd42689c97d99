"""Training preparation as one job. Records are validated (F5), those with declared personal data leave (F4), the rest is
counted, guarded (F8), split (X1) and written, with a summary.

The input is read once: the accepted records are written to the shared folder while an observation counts what was accepted,
rejected and quarantined. The cut of the split is found on the keys of that table alone. One more pass over it writes training and validation as
JSON lines, partitioned by split, and counts both on the way, so the summary holds what the files hold.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from ..sources.jsonl import write_jsonl_partitioned
from . import split as SP
from .conversation import validate_messages
from .gates import size_guard

SUMMARY = ("accepted bigint, rejected_contains_pii bigint, quarantined bigint, train bigint, validation bigint, guard string, "
           "train_output string, val_output string")


def prepare_sft(spark: SparkSession, records: DataFrame, path: str, id_col: str = "id", seed: int = 42, val_ratio: float = 0.1,
                allow_pii: bool = False, allow_small: bool = False, dry_run: bool = False) -> DataFrame:
    """The summary row; the files are ``path``/split=train and ``path``/split=val. ``records`` has ``messages`` and ``contains_pii``, and an id
    that is a non-negative bigint. Nothing is written for a dry run, nor where the guard refuses the set; its counts are those that the
    files would have. Records that fail validation are left out and counted."""
    wrong = validate_messages("messages").isNotNull()
    declared = F.col("contains_pii").eqNullSafe(True) & F.lit(not allow_pii)
    marked = records.withColumn("_state", F.when(wrong, "quarantined").when(declared, "rejected").otherwise("accepted"))
    seen = Observation()
    staged = shared_path(spark, f"prepare/{uuid.uuid4().hex}")
    (marked.observe(seen, *[F.count_if(F.col("_state") == s).alias(s) for s in ("quarantined", "rejected", "accepted")])
           .filter("_state = 'accepted'").drop("_state").write.parquet(staged))
    counts = seen.get
    n = counts["accepted"]
    guard = spark.range(1).select(size_guard(F.lit(n), allow_small)).first()[0]
    val = max(1, int(n * val_ratio)) if n > 1 else 0
    train = n - val or n
    if guard == "ok" and not dry_run:
        accepted = spark.read.schema(records.schema).parquet(staged)
        split = SP.seeded_split(accepted, id_col, seed, val_ratio)
        # a record that is both stands in both files
        both = split.withColumn("split", F.explode(F.when(F.col("split") == "both", F.array(F.lit("train"), F.lit("val"))).otherwise(F.array("split"))))
        written = Observation()
        counted = both.observe(written, F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "val").alias("val"))
        write_jsonl_partitioned(counted, path, ["split"])
        train, val = written.get["train"], written.get["val"]
    row = (n, counts["rejected"], counts["quarantined"], train, val, guard, f"{path}/split=train", f"{path}/split=val")
    return spark.createDataFrame([row], SUMMARY)
