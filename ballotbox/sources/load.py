"""ZIP archives to raw parquet: the load step between download and staging.

Each member is inflated once: its lines go, as they are and with their number of fields,
into a written table below the shared scratch folder, and the same write observes how many
lines of each cycle fit the layout. From there, splittable now, they are parsed into
``<root>/<file type>/cycle=YYYY`` with dynamic partition overwrite: only the cycles
present in the archives are replaced. Lines of another width go to
``<root>/_rejects/<file type>`` the same way. The counts are the load's own; nothing
is read again for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ballotbox import schemas
from ballotbox.session import scratch_path
from ballotbox.sources import parquet, zipsource
from ballotbox.sources.delimited import counted, parse, rejects


def load_zip_to_raw(spark: SparkSession, path: str, file_type: str, raw_root: str, encoding: str = "UTF-8") -> DataFrame:
    """Loads the archives; returns file_type, cycle, row_count and n_rejected of this load."""
    cycles = sorted({a.cycle for a in zipsource.archives(spark, path)})
    fits = F.col("n_fields") == schemas.width(file_type)
    seen = Observation()
    counts = [F.count_if((F.col("cycle") == c) & which).alias(f"{kind}_{c}")
              for c in cycles for kind, which in (("good", fits), ("bad", ~fits))]
    held = scratch_path(spark, "load-lines")
    lines = counted(zipsource.read_zip_lines(spark, path, file_type, encoding=encoding, columns=["value", "cycle"]))
    lines.observe(seen, *counts).write.option("compression", "zstd").parquet(held)
    found = {c: (seen.get[f"good_{c}"], seen.get[f"bad_{c}"]) for c in cycles}

    # in the order that the writes want, sorted as lines: rows of fields are several times as wide
    lines = spark.read.schema(lines.schema).parquet(held).sortWithinPartitions("cycle")
    bad_root = f"{raw_root.rstrip('/')}/_rejects"
    parquet.write_raw(parse(lines, file_type), raw_root, file_type)
    if any(bad for _, bad in found.values()):
        parquet.write_raw(rejects(lines, file_type), bad_root, file_type)
    for cycle, (good, bad) in found.items():        # an overwrite without rows leaves what was there
        for root, n in ((raw_root, good), (bad_root, bad)):
            if not n:
                parquet.drop_cycle(spark, root, file_type, cycle)
    return spark.createDataFrame([(file_type, c, *n) for c, n in found.items()],
                                 "file_type string, cycle int, row_count long, n_rejected long")
