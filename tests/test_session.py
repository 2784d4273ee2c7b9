from wardbook.session import SHUFFLE_PARTITION_BYTES, cluster_settings


def test_shuffle_partitions_follow_the_data():
    def partitions(size, cores):
        return int(cluster_settings(size, cores)["spark.sql.shuffle.partitions"])

    assert partitions(0, 64) == 64
    assert partitions(10 * 1024**4, 4000) == 10 * 1024**4 // SHUFFLE_PARTITION_BYTES
