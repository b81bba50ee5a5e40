from pyspark.sql import SparkSession


def local_session():
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("billtrace-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
