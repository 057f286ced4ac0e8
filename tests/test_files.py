"""Footers, row groups, hashes, samples and projections."""

import hashlib
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpusledger.operators import project, sample
from corpusledger.runtime import scratch_path
from corpusledger.sources import dumps, files


@pytest.fixture(scope="module")
def layout(spark):
    """Two dumps of three files with row groups of seven rows."""
    base = scratch_path(spark, "layout")
    number = 0
    for dump in ("d-2017-04", "d-2018-05"):
        folder = f"{base}/source_config={dump}"
        os.makedirs(folder)
        for shard in range(3):
            rows = 20 + shard
            table = pa.table({"n": list(range(number, number + rows)), "text": [f"text {i}" for i in range(rows)]})
            pq.write_table(table, f"{folder}/{shard:03d}.parquet", row_group_size=7, compression="zstd")
            number += rows
    open(f"{base}/source_config=d-2017-04/003.parquet.tmp", "w").close()
    return base


def test_discovery(spark, layout):
    found = files.dump_discovery(spark, layout, "d-2017-", "source_config=").collect()
    assert [(r["source_config"], r["shards"], r["first_shard"]) for r in found] == [
        ("d-2017-04", 3, "000.parquet")
    ]
    folder = f"{layout}/source_config=d-2017-04"
    sizes = [os.path.getsize(f"{folder}/{n}") for n in os.listdir(folder) if n.endswith(".parquet") and n[0] != "."]
    assert found[0]["bytes"] == sum(sizes)
    assert [r["path"].rsplit("/", 1)[1] for r in files.leftovers(spark, layout).collect()] == [
        "003.parquet.tmp"
    ]


def test_empty_and_deep_files_are_listed(spark, tmp_path):
    base = tmp_path / "out dir"
    deep = base / "source_config=d" / "shard=0" / "more"
    deep.mkdir(parents=True)
    pq.write_table(pa.table({"n": [1]}), deep / "one.parquet")
    (base / "source_config=d" / "none.parquet").touch()
    (deep / "half.tmp").write_text("x")
    (deep / "none.tmp").touch()
    (base / "source_config=d" / "_temporary").mkdir()
    sizes = {r["name"]: r["size"] for r in files.list_files(spark, str(base)).collect()}
    assert sizes == {"one.parquet": (deep / "one.parquet").stat().st_size, "none.parquet": 0}
    left = {r["path"].rsplit("/", 1)[1]: r["size"] for r in files.leftovers(spark, str(base)).collect()}
    assert left == {"half.tmp": 1, "none.tmp": 0, "_temporary": 0}


def test_leftovers_below_the_deepest_file(spark, tmp_path):
    base = tmp_path / "out 100%"
    (base / "a" / "b" / "c" / "_temporary").mkdir(parents=True)
    (base / "d" / "_temporary" / "0").mkdir(parents=True)
    assert sorted(r["path"].split("/out 100%/")[1] for r in files.leftovers(spark, str(base)).collect()) == [
        "a/b/c/_temporary", "d/_temporary",
    ]
    (base / "a" / "one.tmp").write_text("x")
    assert files.leftovers(spark, str(base)).count() == 3
    assert files.leftovers(spark, str(tmp_path / "a" / "none")).count() == 0


def test_footers(spark, layout):
    footers = files.footer_scan(files.list_files(spark, layout))
    for row in files.shard_footers(footers).collect():
        meta = pq.ParquetFile(row["path"].removeprefix("file:")).metadata
        assert (row["rows"], row["row_groups"], row["codecs"]) == (meta.num_rows, meta.num_row_groups, ["ZSTD"])
        text = [meta.row_group(i).column(1) for i in range(meta.num_row_groups)]
        assert row["text_compressed_bytes"] == sum(c.total_compressed_size for c in text)
        assert row["text_uncompressed_bytes"] == sum(c.total_uncompressed_size for c in text)


def test_row_groups(spark, layout):
    footers = files.footer_scan(files.list_files(spark, layout))
    rows = files.row_group_slice(spark.read.parquet(layout), footers, [0, 2], ["n"]).collect()
    expected = set()
    number = 0
    for _ in range(2):
        for shard in range(3):
            size = 20 + shard
            expected |= {(number + i, i // 7, i % 7) for i in range(size) if i // 7 in (0, 2)}
            number += size
    assert {(r["n"], r["row_group"], r["row"]) for r in rows} == expected
    leading = sample.leading_groups(footers, 2).collect()
    assert {r["leading_rows"] for r in leading} == {14}


def test_output_sample_opens_only_chosen_shards(spark):
    base = scratch_path(spark, "shards")
    os.makedirs(base)
    for shard in range(6):
        rows = 25
        table = pa.table(
            {
                "date": pa.array([2013] * rows, pa.int32()),
                "text": [f"{shard} {row}" for row in range(rows)],
                "token_count": pa.array(range(rows), pa.int32()),
            }
        )
        pq.write_table(table, f"{base}/s-{shard:05d}.parquet", row_group_size=10)
    listed = files.list_files(spark, base).withColumnRenamed("name", "shard_name")
    drawn = sample.sample_output(listed, seed=3, shard_count=4, rows_per_shard=5).collect()
    groups = {(r["shard"], r["row_group"]) for r in drawn}
    assert len(groups) == len({s for s, _ in groups}) == 4
    assert {g for _, g in groups} <= {0, 1, 2} and len(drawn) == 20
    for r in drawn:
        place = r["row_group"] * 10 + r["row"]
        assert r["text"] == f"{int(r['shard'][2:7])} {place}" and r["token_count"] == place
    again = sample.sample_output(listed, seed=3, shard_count=4, rows_per_shard=5).collect()
    assert sorted(again) == sorted(drawn)


def test_scan_and_positions(spark, layout):
    rows = dumps.source_positions(dumps.scan_dumps(spark, layout))
    found = rows.where("source_config = 'd-2018-05'").orderBy("position").collect()
    assert [r["position"] for r in found] == list(range(63))
    assert [r["text"] for r in found] == [f"text {i}" for size in (20, 21, 22) for i in range(size)]
    one = dumps.scan_dumps(spark, layout, ["d-2017-04"])
    assert one.count() == 63
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "source_config" in plan.split("PartitionFilters")[1][:80]
    assert "ReadSchema: struct<text:string," in plan


def test_hashes(spark, layout):
    for row in files.file_digests(files.list_files(spark, layout), chunk=100).collect():
        with open(row["path"].removeprefix("file:"), "rb") as handle:
            assert row["sha256"] == hashlib.sha256(handle.read()).hexdigest()


def test_cluster_sample(spark):
    rows = spark.range(400).select(
        F.format_string("s%02d", (F.col("id") / 20).cast("int")).alias("shard"), (F.col("id") % 20).alias("row")
    )
    shards = rows.groupBy("shard").agg(F.count("*").alias("rows"))

    def draw(seed, **changes):
        options = dict(seed=seed, shard_count=5, rows_per_shard=4, group_rows=6) | changes
        return sample.cluster_sample(rows.repartition(3), shards, **options)

    drawn = draw(1).collect()
    groups = {(r["shard"], r["row_group"]) for r in drawn}
    assert len(groups) == len({s for s, _ in groups}) == 5
    assert all(r["row"] // 6 == r["row_group"] for r in drawn)
    assert drawn and sorted(drawn) == sorted(draw(1).collect()) != sorted(draw(2).collect())
    assert draw(1, shard_count=99, rows_per_shard=99, group_rows=20).count() == 400


def test_systematic_and_indexed(spark):
    names = [f"d{n:02d}" for n in range(12)]
    table = spark.createDataFrame([(n,) for n in names], "source_config string")
    for count, expected in [(3, names[::4][:3]), (5, names[::2][:5]), (20, names)]:
        got = sorted(r[0] for r in sample.systematic_dumps(table, count).collect())
        assert got == expected
    shards = spark.createDataFrame([("a", s) for s in range(14)] + [("b", s) for s in range(3)], "source_config string, shard int")
    picked = sample.indexed_shards(shards, [0, 6, 13]).collect()
    assert {(r["source_config"], r["shard"]) for r in picked} == {("a", 0), ("a", 6), ("a", 13), ("b", 0)}
    middle = {r["source_config"]: r["shard"] for r in sample.middle_shards(shards).collect()}
    assert middle == {"a": 7, "b": 1}


def test_audit_flags_counts_and_dates(spark):
    drawn = spark.createDataFrame(
        [("s", 0, 0, 2013, 5, 5), ("s", 0, 1, 2013, 5, 6), ("s", 0, 2, 2012, 5, 5), ("t", 1, 0, 2013, 1, 1)],
        "shard string, row_group int, row bigint, date int, stored_token_count bigint, recounted_token_count bigint",
    )
    rows = {r["shard"]: (r["rows_audited"], r["mismatches"], r["verdict"]) for r in sample.audit_counts(drawn, 2013).collect()}
    assert rows == {"s": (3, 2, "FAIL"), "t": (1, 0, "PASS")}
    assert {r["row"] for r in sample.audit_mismatches(drawn, 2013).collect()} == {1, 2}


# Published measurements of 2013 and what was projected from them.
SAMPLED = [("CC-MAIN-2013-20", 60000, 62228803, 284754880), ("CC-MAIN-2013-48", 60000, 62375670, 285175117)]
ROWS = [("CC-MAIN-2013-20", 11002672), ("CC-MAIN-2013-48", 10797532)]
BYTES_PER_ROW = {"CC-MAIN-2013-20": 2026.3388333333332, "CC-MAIN-2013-48": 2022.8931166666666}


def test_published_projection(spark):
    sampled = spark.createDataFrame(
        SAMPLED, "source_config string, sampled_rows bigint, sampled_tokens bigint, sampled_utf8_bytes bigint"
    )
    held = spark.createDataFrame(ROWS, "source_config string, available_rows bigint")
    projected = project.token_projection(sampled, held)
    first = projected.where("source_config = 'CC-MAIN-2013-20'").first()
    assert first["tokens_per_row"] == pytest.approx(1037.1467166666666, rel=1e-12)
    assert first["utf8_bytes_per_token"] == pytest.approx(4.575933752092259, rel=1e-12)
    assert first["projected_tokens"] == pytest.approx(11411385139.360266, rel=1e-12)
    year = project.year_projection(projected, 100_000_000_000).first()
    assert year["projected_year_tokens"] == pytest.approx(22636440020.134262, rel=1e-12)
    assert year["total_rows"] == 21_800_204 and year["below_target"]


def test_published_storage(spark):
    held = spark.createDataFrame(
        [(n, r, BYTES_PER_ROW[n]) for n, r in ROWS], "source_config string, available_rows bigint, bytes_per_row double"
    )
    storage = project.dump_storage(held, 250_000)
    assert {r["source_config"]: r["shards"] for r in storage.collect()} == {
        "CC-MAIN-2013-20": 45, "CC-MAIN-2013-48": 44,
    }
    fixed = (12 + 450 + 1) * 1024**2
    rolled = project.storage_rollup(storage, rows_per_shard=250_000, free_bytes=367609430016, fixed_bytes=fixed)
    rows = {r["scenario"]: r for r in rolled.collect()}
    keep, delete = rows["keep_all"], rows["delete_after_publish"]
    assert keep["output_bytes"] == pytest.approx(44137394703.8174, rel=1e-12)
    assert keep["shard_bytes"] == pytest.approx(506584708.3333333, rel=1e-12)
    assert keep["peak_bytes"] == pytest.approx(45636054808.48406, rel=1e-12)
    assert delete["peak_bytes"] == pytest.approx(2005244812.9999998, rel=1e-12)
    assert keep["headroom_multiple"] == pytest.approx(8.055241224481543, rel=1e-12)
    assert delete["free_gib_after"] == pytest.approx(340.4954310534522, rel=1e-12)
    assert keep["fits"] and delete["fits"] and keep["shards"] == 89


def test_published_multi_year(spark):
    # Rows, source bytes, sampled tokens per row and output bytes per row by year.
    years = [
        (2017, 171755787, 485087827730, 978.9965555555556, 1892.327388888889),
        (2018, 162307975, 452656076254, 943.9526111111111, 1846.15175),
        (2019, 152599285, 442101214477, 992.7753611111111, 1934.1100833333333),
    ]
    held = spark.createDataFrame(
        [(y, f"d{y}", rows, size) for y, rows, size, _, _ in years],
        "year int, source_config string, available_rows bigint, source_bytes bigint",
    )
    sampled = spark.createDataFrame(
        [(y, 36000, round(per * 36000), out) for y, _, _, per, out in years],
        "year int, sampled_rows bigint, sampled_tokens bigint, output_bytes_per_row double",
    )
    plan = project.multi_year_plan(held, sampled, 100_000_000_000)
    first = plan.where("year = 2017").first()
    assert first["keep_fraction"] == pytest.approx(0.5947130348885968, rel=1e-9)
    assert first["output_bytes_at_target"] == pytest.approx(193292548186.24374, rel=1e-9)
    assert first["exceeds_target"]
    total = project.multi_year_totals(plan).where("year IS NULL").first()
    assert total["total_rows"] == 486_663_047 and total["source_bytes"] == 1_379_845_118_461
    assert total["projected_tokens"] == pytest.approx(472856170946.313, rel=1e-9)
    assert total["output_tib_at_target"] == pytest.approx(0.5308609529340251, rel=1e-9)


def test_published_storage_estimate(spark):
    # A dump's sampled rows and text bytes per row, plain and compressed.
    rows, plain, packed = 1571812, 4870.969689123127, 2907.7878976620614
    listing = spark.createDataFrame(
        [("CC-MAIN-2013-20", f"s{n:02d}", 100) for n in range(14)], "source_config string, path string, size bigint"
    )
    half = rows // 2
    footers = spark.createDataFrame(
        [
            ("s00", half, ["SNAPPY"], round(packed * half), round(packed * half), round(plain * half)),
            ("s01", rows - half, ["SNAPPY"], round(packed * (rows - half)), round(packed * (rows - half)), round(plain * (rows - half))),
            ("s02", 9, ["GZIP"], 9, 9, 9),
        ],
        "path string, rows bigint, codecs array<string>, compressed_bytes bigint, "
        "text_compressed_bytes bigint, text_uncompressed_bytes bigint",
    )
    held = spark.createDataFrame(ROWS[:1], "source_config string, available_rows bigint")
    row = project.storage_estimate(listing, footers, held, 2).first()
    assert (row["source_shards"], row["source_bytes"], row["sampled_rows"]) == (14, 1400, rows)
    assert row["sampled_codecs"] == ["SNAPPY"]
    assert row["projected_text_bytes"] == pytest.approx(53593681811.36373, rel=1e-6)
    assert row["projected_text_compressed_bytes"] == pytest.approx(31993436483.545227, rel=1e-6)


def test_output_ratio(spark, docs):
    rows = docs.select(F.lit(2013).alias("date"), "text", F.lit(1).alias("token_count"))
    found = {r["codec"]: r for r in project.output_ratio(rows, ["zstd", "snappy", "zstd"]).collect()}
    assert set(found) == {"zstd", "snappy"}
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    for row in found.values():
        assert row["text_utf8_bytes"] == size and row["rows"] == docs.count()
        assert row["ratio_vs_text_utf8"] == pytest.approx(row["file_bytes"] / size)
    assert found["zstd"]["file_bytes"] < found["snappy"]["file_bytes"]
