"""Rows that name nobody do not meet in one task, and get the same persons."""

from lendmart.operators import leads as ld

FIELDS = {"name": "name_user"}


def sides(spark, people):
    df = spark.sql("SELECT id AS uid, CASE id % 12 WHEN 3 THEN 100 + id % 7 WHEN 4 THEN NULL ELSE 0 END AS agent_uid FROM range(6000)")
    return df, spark.createDataFrame([(u, f"p{u}") for u in people], "uid long, name_user string")


def test_same_persons_with_and_without_spreading(spark):
    for people in ([100, 101, 105], [0, 100, 106], []):
        df, p = sides(spark, people)
        got = ld.attach_person(df, p, "agent_uid", FIELDS, spread_by="uid")
        want = ld.attach_person(df, p, "agent_uid", FIELDS)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert got.filter("name = 'p0'").count() == (5000 if 0 in people else 0)


def test_rows_without_an_agent_are_dealt_evenly(spark):
    """All parts of the join's exchange hold rows, none most of them."""
    df, p = sides(spark, [100, 101])
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        users = df.selectExpr("*", "'' fname")
        role = next(iter(ld.ROLE_FIELDS))
        sizes = ld.attach_person(users, p, role, FIELDS, spread_by="uid").rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 6000 and len(sizes) == 8 and max(sizes) < 3 * 6000 / 8
