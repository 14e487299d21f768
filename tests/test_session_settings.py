"""Settings of the marts' shuffles hold for marts; other queries find what the session's owner has set."""

from lendmart.session import MART_SETTINGS, tune

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def test_own_values_come_back_after_a_mart(spark):
    before = {key: spark.conf.get(key, None) for key in MART_SETTINGS}
    try:
        spark.conf.set(ADVISORY, "8m")
        tune(spark, marts=False)
        assert spark.conf.get(ADVISORY) == "8m"
        for _ in range(2):
            tune(spark)
            assert spark.conf.get(ADVISORY) == MART_SETTINGS[ADVISORY]
        tune(spark, marts=False)
        assert spark.conf.get(ADVISORY) == "8m"
        spark.conf.unset(ADVISORY)
        tune(spark)
        tune(spark, marts=False)
        assert spark.conf.get(ADVISORY, None) is None
        # A value set between two queries is the owner's too.
        tune(spark)
        spark.conf.set(ADVISORY, "16k")
        tune(spark, marts=False)
        assert spark.conf.get(ADVISORY) == "16k"
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
