from panelspark.session import apply_settings, scale_settings


def test_partitions_follow_the_data(spark):
    assert scale_settings(100 * 10**12, 8000)["spark.sql.shuffle.partitions"] == str(-(-(100 * 10**12) // 2**27))
    assert scale_settings(10**12, 400)["spark.sql.shuffle.partitions"] == str(-(-(10**12) // 2**27))
    assert scale_settings(0, 4)["spark.sql.shuffle.partitions"] == "8"
    fresh = apply_settings(spark.newSession(), 0, 2)
    assert fresh.conf.get("spark.sql.shuffle.partitions") == "4"
