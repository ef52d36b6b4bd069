"""Replacing and extending tables: failures, concurrent writers, readers in between, leftovers."""

import pytest

from marginloom.sources import (
    HeaderError,
    Versions,
    append_rules,
    load_rules,
    publish_table,
    published_versions,
    replace_rules,
    rules_from_rows,
)


@pytest.fixture
def rules(spark):
    def build(*keys):
        return rules_from_rows(spark, [("vendor", k, "Retail", None) for k in keys]).selectExpr("*", "'d' AS description")

    return build


def keys(spark, path):
    return sorted(r.key for r in load_rules(spark, path).collect())


def failing(rules):
    """Rules of which the last partition can't be written."""
    more = rules.unionByName(rules.selectExpr("type", "raise_error('lost') AS key", "channel", "value", "description"))
    return more.repartition(3, "key")


def test_a_job_that_fails_half_way_leaves_the_old_rules(spark, rules, tmp_path):
    path = str(tmp_path / "rules")
    replace_rules(rules("1", "2"), path)
    for write in (replace_rules, append_rules):
        with pytest.raises(Exception, match="lost"):
            write(failing(rules("3", "4")), path)
        assert keys(spark, path) == ["1", "2"]
    assert Versions(spark, path).numbers() == [1]
    append_rules(rules("5"), path)
    assert keys(spark, path) == ["1", "2", "5"]


def test_rules_can_be_replaced_by_themselves(spark, rules, tmp_path):
    path = str(tmp_path / "rules")
    replace_rules(rules("1", "2", "3"), path)
    replace_rules(load_rules(spark, path).where("key <> '2'"), path)
    replace_rules(load_rules(spark, path), path)
    assert keys(spark, path) == ["1", "3"]


def test_a_reader_that_has_begun_keeps_its_version(spark, rules, tmp_path):
    path = str(tmp_path / "rules")
    replace_rules(rules("1"), path)
    begun = load_rules(spark, path)
    replace_rules(rules("2"), path)
    Versions(spark, path).vacuum()
    assert [r.key for r in begun.collect()] == ["1"] and keys(spark, path) == ["2"]


def test_tables_without_versions(spark, rules, tmp_path):
    path = str(tmp_path / "rules")
    rules("1").write.option("header", True).csv(path)
    assert keys(spark, path) == ["1"]
    append_rules(rules("2").select("description", "key", "type", "value", "channel"), path)
    assert keys(spark, path) == ["1", "2"]
    replace_rules(rules("3"), path)
    assert keys(spark, path) == ["3"]
    file = tmp_path / "hand.csv"
    file.write_text("Type,Key,Channel,Value,Description\nvendor,9,Retail,,\n")
    assert keys(spark, str(file)) == ["9"]
    with pytest.raises(ValueError, match="is a file"):
        replace_rules(rules("1"), str(file))


def test_append_needs_the_same_columns(spark, rules, tmp_path):
    path = str(tmp_path / "rules")
    replace_rules(rules("1"), path)
    with pytest.raises(HeaderError):
        append_rules(rules("2").drop("description"), path)
    assert keys(spark, path) == ["1"]


def test_two_writers_at_once_lose_nothing(spark, rules, tmp_path, monkeypatch):
    path = str(tmp_path / "rules")
    replace_rules(rules("1"), path)
    commit, once = Versions._commit, []

    def late(self, number, names):
        if not once:
            once.append(True)
            append_rules(rules("2"), path)  # another writer commits between looking and committing
        return commit(self, number, names)

    monkeypatch.setattr(Versions, "_commit", late)
    append_rules(rules("3"), path)
    assert keys(spark, path) == ["1", "2", "3"] and Versions(spark, path).numbers() == [1, 2, 3]


def test_vacuum(spark, rules, tmp_path):
    path = str(tmp_path / "rules")
    for key in "123":
        replace_rules(rules(key), path)
    with pytest.raises(Exception, match="lost"):
        replace_rules(failing(rules("4")), path)
    versions = Versions(spark, path)
    assert versions.vacuum(keep=1, hours=1) == []
    gone = versions.vacuum(keep=2, hours=0)
    assert [n for n in gone if n.startswith("manifest")] == ["manifest-00000001"] and len(gone) >= 2
    assert versions.numbers() == [2, 3] and keys(spark, path) == ["3"]
    assert [r.Key if "Key" in r else r.key for r in spark.read.option("header", True).csv(versions.folders(2)).collect()] == ["2"]


def test_published_table_switches_in_one_step(spark, tmp_path, got):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shop LOCATION '{tmp_path}/shop'")
    table = lambda n: spark.range(n).selectExpr("id", "id % 2 AS part")
    for parts in (None, ["part"]):
        publish_table(table(3), "shop.t", parts)
        begun = spark.table("shop.t")
        entry = spark.sql("DESCRIBE TABLE EXTENDED shop.t").where("col_name = 'Created Time'").collect()
        with pytest.raises(Exception, match="lost"):
            publish_table(table(4).selectExpr("if(id = 3, raise_error('lost'), id) AS id", "part"), "shop.t", parts)
        assert got(spark.table("shop.t"), "id") == [(0,), (1,), (2,)]
        publish_table(table(5), "shop.t", parts)
        assert got(spark.table("shop.t"), "id", "part") == [(n, n % 2) for n in range(5)]
        assert spark.sql("DESCRIBE TABLE EXTENDED shop.t").where("col_name = 'Created Time'").collect() == entry
        assert begun.count() == 3
        publish_table(spark.table("shop.t").where("id > 3"), "shop.t", parts)
        assert got(spark.table("shop.t"), "id") == [(4,)]
    publish_table(table(2).selectExpr("id", "'x' AS name"), "shop.t")
    assert spark.table("shop.t").columns == ["id", "name"]
    assert published_versions(spark, "shop.t").vacuum(hours=0)
    assert spark.table("shop.t").count() == 2
    spark.sql("DROP TABLE shop.t")
