"""Readers, writers and document extraction."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakestrata.plans import raw
from lakestrata.sources.documents import housing_table
from lakestrata.sources.files import (
    Lake, clean_headers, create_layers, read_broken_records, read_delimited, read_record_lines,
)


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_codes_keep_their_zeros(spark, tmp_path):
    path = write(tmp_path / "c.csv", "code;n\n01004;3\n2A004;x\n")
    got = read_delimited(spark, path, "code string, n int", ";")
    assert sorted(map(tuple, got.collect())) == [("01004", 3), ("2A004", None)]


def test_raw_tables_by_name(spark, tmp_path):
    path = write(tmp_path / "w.csv", "department (code);Date;Température, brute;Température (°C)\n1;2020-01-05T10:00:00+00:00;x;2.5\n")
    got = raw.read_raw(spark, "weather", path)
    assert got.columns == ["department (code)", "Date", "Température brute", "Température (°C)"]
    assert got.select(F.year("Date"), "Température (°C)").first() == (2020, 2.5)
    path = write(tmp_path / "p.csv", "#Code_commune_INSEE;Code_postal\n01004;1500\n")
    got = raw.read_raw(spark, "code_commune", path)
    assert [tuple(r) for r in got.collect()] == [("01004", "1500")] and got.columns[0] == "Code_commune_INSEE"
    path = write(tmp_path / "d.csv", "N°DPE,Année_construction\na,1980\na,1980\nb,\n")
    got = raw.read_raw(spark, "dpe_france_2021", path)
    assert sorted(map(tuple, got.collect())) == [("a", 1980), ("b", None)]
    path = write(tmp_path / "s.csv", "COMM;NB_LGT_TOT_CREES;DATE_REELLE_AUTORISATION\n01004;3;2017-01-01\n")
    assert str(raw.read_raw(spark, "construction_licence_2016", path).first()[2]) == "2017-01-01"


def test_clean_headers(spark):
    assert clean_headers(spark.createDataFrame([(1, 2)], "`a,b` int, c int")).columns == ["ab", "c"]


def test_edges_from_a_text_file(spark, tmp_path):
    path = write(tmp_path / "n.txt", "01:02,03\n2A:20\n4|5\n\n20;2B\n")
    got = raw.neighbour_edges(spark.read.text(path))
    assert sorted(map(tuple, got.collect())) == [(1, 2), (1, 3), (4, 5)]


def test_mainland_list(spark):
    df = spark.createDataFrame([("75001",), ("2A004",), ("01004",), ("97101",), ("96000",)], "Code_commune_INSEE string")
    assert [r[0] for r in raw.mainland_municipalities(df).collect()] == ["01004", "75001"]


def test_record_lines_keep_file_order_over_splits(spark, tmp_path):
    lines = [f"{i},{'x' * (i % 40)}" for i in range(5000)]
    path = write(tmp_path / "l.csv", "\n".join(lines) + "\n")
    write(tmp_path / "m.csv", "only,one\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_record_lines(spark, str(tmp_path))
        got = [r.line for r in df.where(F.col("source").endswith("l.csv")).orderBy("pos").collect()]
        assert df.select("source", "pos").distinct().count() == 5001
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == lines and path


def test_broken_records_are_repaired_and_typed(spark, tmp_path):
    write(tmp_path / "b.csv", "id,t,u\n1,a,b\n2,first_\nsecond,c\n3,d_\n,e\nx,y,z\n")
    write(tmp_path / "c.csv", "id,t,u\n4,f,g\n")
    paths = [str(tmp_path / "b.csv"), str(tmp_path / "c.csv")]
    got = read_broken_records(spark, paths, {"id": "int"}, min_fields=3, malformed="bad")
    assert got.columns == ["id", "t", "u", "bad"]
    rows = sorted(map(tuple, got.collect()), key=lambda r: (r[0] is None, r[0] or 0))
    assert rows == [(1, "a", "b", None), (2, "firstsecond", "c", None), (3, "d", "e", None), (4, "f", "g", None), (None, "y", "z", "x,y,z")]


def test_columns_are_found_by_their_header(spark, tmp_path):
    write(tmp_path / "b.csv", "t,id\na,1\n")
    assert read_broken_records(spark, str(tmp_path / "b.csv"), {"id": "int"}, min_fields=2).collect() == [("a", 1)]
    write(tmp_path / "c.csv", "id,t\n2,b\n")
    with pytest.raises(Exception, match="different headers"):
        read_broken_records(spark, str(tmp_path), {"id": "int"}, min_fields=2).collect()


def test_malformed_lines_are_kept(spark, tmp_path):
    path = write(tmp_path / "c.csv", "code;n\n01004;3\n2A004;x\n")
    rows = read_delimited(spark, path, "code string, n int", ";", malformed="bad").collect()
    assert sorted(map(tuple, rows)) == [("01004", 3, None), ("2A004", None, "2A004;x")]


def test_raw_layer_run(spark, tmp_path):
    from lakestrata.plans import run

    paths = {
        "code_commune": write(tmp_path / "c.csv", "#Code_commune_INSEE;Code_postal\n01004;1500\n"),
        "pop_commune_2016": write(tmp_path / "p.csv", "DEPCOM;COM;PMUN\n01004;x;12\n01005;y;oops\n"),
        "neighbouring_dep": write(tmp_path / "n.txt", "01:02,03\n"),
        "codebook": write(tmp_path / "b.csv", "Name;LABEL\nq;what\n"),
        "dpe_france_2012": write(tmp_path / "d.csv", "a,date_etablissement_dpe\nlo_\nng,2020-01-02\n"),
    }
    lake = Lake(spark, str(tmp_path / "lake"))
    from unittest import mock

    with mock.patch.object(run.read_broken_records, "__defaults__", (None, ",", 2, None)):
        audit = {r.table_name: (r.n_rows, r.n_malformed) for r in run.build_raw(lake, paths, broken=("dpe_france_2012",)).collect()}
    assert audit == {"code_commune": (1, 0), "pop_commune_2016": (2, 1), "neighbouring_dep": (2, 0), "codebook": (1, 0), "dpe_france_2012": (1, 0)}
    assert lake.read("Datalake", "dpe_france_2012").first().a == "long"


CELL = "<Cellule><Modalite code='{}'/><Mesure>{}</Mesure><Valeur>{}</Valeur></Cellule>"


def test_dwelling_documents(spark):
    homes = "Nombre de logements"
    docs = {
        "ok": "<D>" + CELL.format(1, homes, "12.7") + CELL.format(2, homes, "5") + CELL.format(1, "Surface", "9") + "</D>",
        "last": "<D>" + CELL.format(1, homes, "1") + CELL.format(1, homes, "3") + "</D>",
        "cut": "<D>" + CELL.format(1, homes, "4") + CELL.format(2, homes, "many") + CELL.format(2, homes, "8") + "</D>",
        "single": "<D>" + CELL.format(3, homes, "6") + "</D>",
        "broken": "<D><Cellule>", "empty": "<D></D>", "text": "no document", "null": None,
    }
    df = spark.createDataFrame(list(docs.items()), "code string, xml string")
    got = {r.code: (r.houses, r.apartments) for r in housing_table(df, "code", "xml").collect()}
    assert got == {"ok": (12, 5), "last": (3, 0), "cut": (4, 0), "single": (0, 6), "broken": (0, 0), "empty": (0, 0),
                   "text": (0, 0), "null": (0, 0)}


def test_lake_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "é"), (2, None)], "a int, `b c` string").withColumnRenamed("b c", "b")
    lake = Lake(spark, str(tmp_path))
    lake.write(df.union(df), "Silver", "T")
    assert sorted(map(tuple, lake.write(df, "Silver", "T").collect()), key=repr) == [(1, "é"), (2, None)]


def test_catalog_layers(spark):
    create_layers(spark)
    create_layers(spark)
    catalog = Lake(spark)
    catalog.write(spark.range(3), "Gold", "numbers")
    assert catalog.write(spark.range(2), "Gold", "numbers").count() == 2
    spark.sql("DROP TABLE Gold.numbers")


def test_raw_layer_run_with_every_kind_of_file(spark, tmp_path):
    from lakestrata.plans import codes, run

    cell = CELL.format(1, "Nombre de logements", "12") + CELL.format(2, "Nombre de logements", "5")
    documents = spark.createDataFrame([("01004", f"<D>{cell}</D>"), ("01005", "no document")], f"{codes.DOCUMENT_CODE} string, {codes.DOCUMENT_TEXT} string")
    documents.write.parquet(str(tmp_path / "documents"))
    paths = {
        "housings": str(tmp_path / "documents"), "weather": write(tmp_path / "w.csv", "department (code);Date;Température (°C)\n1;2020-01-05T10:00:00;2.5\n"),
        "dpe_france_2021": write(tmp_path / "d.csv", "N°DPE,Année_construction\na,1980\na,1980\nb,x\n"),
        "neighbouring_dep": write(tmp_path / "n.txt", "01:02\n"), "codebook": write(tmp_path / "b.csv", "Name;LABEL\nq;what\n"),
    }
    lake = Lake(spark, str(tmp_path / "lake"), buckets=3)
    audit = {r.table_name: (r.n_rows, r.n_malformed) for r in run.build_raw(lake, paths).collect()}
    assert audit == {"housings": (2, 0), "weather": (1, 0), "dpe_france_2021": (2, 1), "neighbouring_dep": (1, 0), "codebook": (1, 0)}
    assert {tuple(r) for r in lake.read("Datalake", "housings").collect()} == {("01004", 12, 5), ("01005", 0, 0)}


def test_counts_are_taken_by_the_write(spark, tmp_path):
    """One read of the input for the table and its counts."""
    from lakestrata.plans import run

    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    df = spark.range(1000).mapInArrow(seen, "id bigint")
    lake = Lake(spark, str(tmp_path))
    assert run.write_counted(lake, df, "Silver", "T", F.count(F.lit(1)), F.max("id")) == [1000, 999]
    assert reads.value == 1000 and lake.read("Silver", "T").count() == 1000


def test_a_failing_write_leaves_the_old_version(spark, tmp_path):
    fails = F.when(F.col("id") < 5, F.col("id")).otherwise(F.raise_error(F.lit("no")).cast("bigint"))
    create_layers(spark)
    for lake, name in ((Lake(spark, str(tmp_path)), "T"), (Lake(spark), "t_old")):
        first = lake.write(spark.range(3), "Silver", name)
        with pytest.raises(Exception, match="no"):
            lake.write(spark.range(10).select(fails.alias("id")), "Silver", name)
        assert lake.read("Silver", name).count() == 3 and first.count() == 3
    spark.sql("DROP TABLE Silver.t_old")


def test_readers_keep_their_version_and_old_ones_go(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), keep=1)
    first = lake.write(spark.range(1), "Silver", "T")
    lake.write(spark.range(2), "Silver", "T")
    assert first.count() == 1 and lake.read("Silver", "T").count() == 2
    lake.write(spark.range(3), "Silver", "T")
    assert lake.read("Silver", "T").count() == 3 and len(list((tmp_path / "silver" / "t").glob("v-*"))) == 2
    with pytest.raises(FileNotFoundError):
        lake.read("Silver", "never")


def test_tables_of_one_key_are_joined_where_they_lie(spark, tmp_path):
    from lakestrata.plans import codes, gold

    import fixtures as fx

    lake = Lake(spark, str(tmp_path), buckets=4)
    towns = fx.frame(spark, {"insee_code": "string", "id_municipality": "bigint"}, [("01001", 4)])
    raw_rows = lake.write(fx.certificates(spark, {}, {}), "Datalake", "dpe_france_2021", bucket_by=[codes.BUCKET_KEYS["dpe_france_2021"]])
    scores = fx.frame(
        spark, {"id_dpe": "string", "surface": "int", "construction_date": "int", "heating_production": "int", "DPE_consumption": "int", "GES_emission": "int", "has_to_renov": "int"},
        [("d0", 1, 1, 2, 0, 0, 1), ("d1", 3, 9, 1, 3, 3, 0)])
    told = lake.write(scores, "Model", "predicted_renov", bucket_by=["id_dpe"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = gold.scored_certificates(raw_rows, told, towns)._jdf.queryExecution().executedPlan().toString()
        joined = raw_rows.select(F.col("`N°DPE`").alias("id_dpe")).join(told, "id_dpe")
        alone = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the join of the two large tables moves nothing; the one Exchange of each side is that of the towns' key
    assert "Exchange hashpartitioning(id_dpe" not in plan and plan.count("SortMergeJoin") >= 1 and "Exchange" not in alone


def test_record_lines_take_the_scan_alone(spark, tmp_path):
    path = write(tmp_path / "l.csv", "a,b\n")
    assert "Exchange" not in read_record_lines(spark, path)._jdf.queryExecution().executedPlan().toString()


def test_records_over_splits_and_files(spark, tmp_path):
    """Splits of a few bytes, so that records, chunks and blocks cross them; the header stands in every file, in one of them twice."""
    want = []
    for k in range(3):
        lines = ["id,t,u"]
        for i in range(400):
            key = f"{k}-{i}"
            want.append((key, "x" * (i % 7), f"{i}"))
            lines.append(f"{key},{'x' * (i % 7)}" + ("_\n" if i % 3 == 0 else "") + f",{i}")
            if k == 1 and i == 200:
                lines.append("id,t,u")
        write(tmp_path / f"f{k}.csv", "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        got = sorted(map(tuple, read_broken_records(spark, str(tmp_path), min_fields=3).collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == sorted((a, b or None, c) for a, b, c in want) or got == sorted(want)
