"""Totals and checks from Parquet footers, against scans of the same files."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpusledger.operators import project, verify
from corpusledger.runtime import scratch_path, session_settings
from corpusledger.sources import files

YEAR = 2013


def write(base, dump, shard, dates, counts, **options):
    from pathlib import Path

    folder = Path(base) / f"source_config={dump}" / f"shard={shard}"
    folder.mkdir(parents=True, exist_ok=True)
    columns = {
        "date": pa.array(dates, pa.int32()), "text": pa.array([f"text {i}" for i in range(len(dates))], pa.string()),
        "token_count": pa.array(counts, pa.int32()),
    }
    pq.write_table(pa.table(columns), folder / "part.parquet", row_group_size=3, **options)


@pytest.fixture
def base(tmp_path):
    """Names that look like numbers and dates, several row groups, one file of each kind of fault."""
    root = tmp_path / "data"
    for shard in range(4):
        write(root, "2013-20", shard, [YEAR] * 7, range(1, 8))
    write(root, "007", 0, [YEAR, YEAR + 1, YEAR, YEAR], [3, 4, 5, 6])
    write(root, "007", 1, [YEAR] * 5, [3, 0, -2, 4, 9])
    write(root, "007", 2, [YEAR, None, YEAR, YEAR], [3, 1, None, 4])
    return str(root)


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def scanned(spark, base):
    return verify.shard_totals(spark.read.schema(verify.WRITTEN).parquet(base), YEAR)


def test_totals_equal_a_scan(spark, base):
    found = verify.footer_totals(spark, base)
    assert rows(found) == rows(verify.scalar_totals(spark, base))
    narrow = found.select("source_config", "shard", "rows", "min_count", "max_count", "min_date", "max_date")
    assert rows(narrow) == rows(scanned(spark, base).select(*narrow.columns))
    assert {r["source_config"] for r in found.collect()} == {"2013-20", "007"}
    extremes = verify.footer_extremes(found).first()
    assert (extremes["rows"], extremes["min_token_count"], extremes["max_token_count"], extremes["bad_shards"]) == (41, -2, 9, 1)


def test_plan_reads_footers_only(spark, base):
    with session_settings(spark, {**verify.FROM_FOOTERS, "spark.sql.maxMetadataStringLength": "1000"}):
        plan = verify.scalar_totals(spark, base)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedAggregation: [")[1].split("]")[0]
    assert all(part in pushed for part in ("COUNT(*)", "COUNT(token_count)", "MIN(token_count)", "MAX(date)"))
    assert "PushedGroupBy: [source_config, shard]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown", None) in (None, "false")


@pytest.mark.parametrize("fault", ["nulls", "no statistics"])
def test_files_without_statistics_are_scanned(spark, base, fault):
    if fault == "nulls":
        write(base, "x", 0, [YEAR] * 4, [None] * 4)
    else:
        write(base, "x", 0, [YEAR] * 4, [4, 5, 6, 7], write_statistics=False)
    assert rows(verify.footer_totals(spark, base)) == rows(verify.scalar_totals(spark, base))
    assert rows(verify.integrity_from_footers(spark, base, YEAR)) == rows(verify.integrity_problems(scanned(spark, base), YEAR))


def test_other_failures_are_not_hidden(spark, tmp_path):
    folder = tmp_path / "data" / "source_config=a" / "shard=0"
    folder.mkdir(parents=True)
    (folder / "part.parquet").write_bytes(b"not parquet at all")
    with pytest.raises(Exception, match="(?i)parquet"):
        verify.footer_totals(spark, str(tmp_path / "data"))


def test_problems_are_counted_in_suspect_shards_only(spark, base):
    found = verify.integrity_from_footers(spark, base, YEAR)
    wanted = [("007", 0, "wrong date", 1), ("007", 1, "non-positive count", 2), ("007", 2, "null scalar", 2), ("007", 2, "wrong date", 1)]
    assert rows(found) == wanted == rows(verify.integrity_problems(scanned(spark, base), YEAR))
    suspects = verify.suspect_shards(verify.footer_totals(spark, base), YEAR)
    assert rows(suspects) == [("007", 0), ("007", 1), ("007", 2)]
    assert "dynamicpruning" in found._jdf.queryExecution().optimizedPlan().toString().lower()


def test_a_clean_year_has_no_problems(spark, tmp_path):
    write(tmp_path / "data", "a", 0, [YEAR] * 3, [1, 2, 3])
    assert verify.integrity_from_footers(spark, str(tmp_path / "data"), YEAR).count() == 0
    assert verify.footer_extremes(verify.footer_totals(spark, str(tmp_path / "data"))).first()["bad_shards"] == 0


def test_storage_bytes_are_those_of_the_files(spark, base):
    listing = files.list_files(spark, base).withColumn("source_config", F.regexp_extract("path", "source_config=([^/]+)/", 1))
    footers = files.shard_footers(files.footer_scan(project.leading_files(listing, 2)))
    dumps = spark.createDataFrame([("2013-20", 28), ("007", 13)], "source_config string, available_rows bigint")
    found = {r["source_config"]: r for r in project.storage_estimate(listing, footers, dumps, 2).collect()}
    from pathlib import Path

    for dump, row in found.items():
        paths = sorted(Path(base).glob(f"source_config={dump}/*/*.parquet"))
        assert row["source_bytes"] == sum(p.stat().st_size for p in paths) and row["source_shards"] == len(paths)
        metas = [pq.ParquetFile(p).metadata for p in paths[:2]]
        text = [m.row_group(g).column(1) for m in metas for g in range(m.num_row_groups)]
        plain, packed = sum(c.total_uncompressed_size for c in text), sum(c.total_compressed_size for c in text)
        assert row["sampled_rows"] == sum(m.num_rows for m in metas)
        assert row["text_bytes_per_row"] == plain / row["sampled_rows"]
        assert row["projected_text_compressed_bytes"] == packed / row["sampled_rows"] * row["expected_rows"]


def test_output_ratio_bytes_are_those_of_the_listing(spark):
    sample = spark.range(500).selectExpr("2013 AS date", "repeat(cast(id AS string), 30) AS text", "1 AS token_count").coalesce(2)
    found = {r["codec"]: r for r in project.output_ratio(sample, ["zstd", "snappy"]).collect()}
    for codec, row in found.items():
        path = scratch_path(spark, "again")
        sample.write.option("compression", codec).parquet(path)
        size = files.list_files(spark, path).agg(F.sum("size")).first()[0]
        assert row["file_bytes"] == size and row["rows"] == 500
        assert row["bytes_per_row"] == size / 500 and row["ratio_vs_text_utf8"] == size / row["text_utf8_bytes"]
