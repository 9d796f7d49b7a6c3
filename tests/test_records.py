"""Records cut by many tasks against whole files read by one."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyloom.schemas import TABLES
from tallyloom.sources import csv_files, records
from tallyloom.sources.records import SWAP, line_effect

HEADER = "customer_id,customer_name,email,phone number,city,country"


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def raw_rows(spark, path, multi_line):
    raw = csv_files.read_raw(spark, TABLES["customers"], str(path), multi_line)
    columns = [*TABLES["customers"].schema.names, csv_files.UNFIT]
    return raw, [tuple(r) for r in raw.orderBy(*csv_files.POSITION).select(*columns).collect()]


def same_rows(spark, path):
    whole = raw_rows(spark, path, True)[1]
    raw, found = raw_rows(spark, path, False)
    assert found == whole
    return raw, found


def plain_effect(line, inside):
    """By characters: a quote opens at the start of a field; in quotes a doubled quote is text, another one ends them."""
    at_start, k = True, 0
    while k < len(line):
        c = line[k]
        if inside:
            if c == '"' and line[k + 1 : k + 2] == '"':
                k += 1
            elif c == '"':
                inside, at_start = False, False
        elif c == ",":
            at_start = True
        else:
            inside, at_start = c == '"' and at_start, False
        k += 1
    return inside


def test_effects_of_lines(spark):
    rng = random.Random(1)
    lines = ["".join(rng.choices('",ab', k=rng.randint(0, 9))) for _ in range(4000)]
    found = spark.createDataFrame([(x,) for x in lines], "x string").select("x", line_effect(F.col("x"))).distinct()
    for line, effect in found.collect():
        assert effect == plain_effect(line, False) + 2 * plain_effect(line, True), line
    long = "a," + '"' + 'x""' * 100_000
    assert spark.createDataFrame([(long,)], "x string").select(line_effect(F.col("x"))).first()[0] == SWAP


def field(rng):
    kind = rng.random()
    if kind < 0.3:
        return "".join(rng.choices("abé ", k=rng.randint(0, 6))).strip()
    if kind < 0.35:
        return 'in"ch'
    text = "".join(rng.choices(["a", "b", ",", '""', "\n", "é", "line\n", '"",""', "\n\n"], k=rng.randint(0, 12)))
    return f'"{text}"'


@pytest.mark.parametrize("seed", range(4))
def test_split_files_equal_whole_files(spark, tmp_path, small_blocks, seed):
    rng = random.Random(seed)
    folder = tmp_path / "customers.csv"
    folder.mkdir()
    for part in range(2):
        body = [",".join([str(n), *[field(rng) for _ in range(rng.choice([5, 5, 5, 5, 4, 6]))]]) for n in range(700)]
        if part:
            body[300] = '300,"' + "long\n" * 3000 + '",e,5,Oslo,Norway'
            body[301:301] = ["", ""]
        (folder / f"{part}.csv").write_text("\n".join([HEADER, *body]) + "\n", encoding="utf-8")
    raw, found = same_rows(spark, folder)
    assert len(found) == 1400 and any(r[-1] for r in found) and any("\n" in (r[1] or "") for r in found)
    assert records.read_lines(spark, str(folder)).rdd.getNumPartitions() > 20
    # the blocks, not the files, are what tasks get
    blocks = raw.groupBy(csv_files.FILE, csv_files.BLOCK).count().collect()
    assert len(blocks) > 20 and max(r["count"] for r in blocks) < 200
    assert raw.rdd.getNumPartitions() > 4


def test_carriage_returns_and_open_ends(spark, tmp_path, small_blocks):
    body = [f'{n},"Ann{n}\r\nB",a@x,5,Oslo,"Nor""way"' for n in range(300)]
    (tmp_path / "crlf.csv").write_bytes("\r\n".join([HEADER, *body, ""]).encode())
    assert [r[1:] for r in same_rows(spark, tmp_path / "crlf.csv")[1]][:1] == [("Ann0\nB", "a@x", "5", "Oslo", 'Nor"way', None)]
    (tmp_path / "no_end.csv").write_text("\n".join([HEADER, '1,"A\nB",a,5,Oslo,Norway']))
    assert len(same_rows(spark, tmp_path / "no_end.csv")[1]) == 1
    (tmp_path / "empty.csv").write_text(HEADER + "\n")
    assert same_rows(spark, tmp_path / "empty.csv")[1] == []


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_records_longer_than_blocks(spark, tmp_path, small_blocks, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        body = [f'{n},"{"name" * (n % 90)}\n,""x",a@x,5,Oslo,"{chr(10).join(["line"] * (n % 7) ** 5)}"' for n in range(200)]
        (tmp_path / "c.csv").write_text("\n".join([HEADER, *body]) + "\n")
        assert len(same_rows(spark, tmp_path / "c.csv")[1]) == 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_another_header_fails(spark, tmp_path):
    folder = tmp_path / "customers.csv"
    folder.mkdir()
    (folder / "a.csv").write_text(HEADER + '\n1,"A\nB",a,5,Oslo,Norway\n')
    (folder / "b.csv").write_text(HEADER.replace("city,country", "country,city") + '\n2,"A\nB",a,5,Norway,Oslo\n')
    with pytest.raises(PySparkException, match="another header"):
        csv_files.read_customers(spark, str(folder)).collect()
