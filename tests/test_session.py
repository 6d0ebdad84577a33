from millrace.session import build_session, shuffle_settings


def test_shuffle_partitions_follow_the_data():
    partitions = lambda size, cores: int(shuffle_settings(size, cores)["spark.sql.shuffle.partitions"])
    assert partitions(1, 8) == 16
    assert partitions(10 * 2**40, 4000) == 20480


def test_session_settings(spark):
    assert build_session(spark__sql__shuffle__partitions="4").conf.get("spark.sql.adaptive.enabled") == "true"
