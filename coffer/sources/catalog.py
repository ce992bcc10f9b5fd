"""Existence checks for catalog tables and for paths."""


def file_system(spark, path):
    """Hadoop file system of ``path`` and the path as that system names it."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def path_exists(spark, path):
    system, location = file_system(spark, path)
    return system.exists(location)


def table_exists(spark, name_or_path):
    """True if a catalog table, temporary view or path of that name exists."""
    if "/" in name_or_path:
        return path_exists(spark, name_or_path)
    return spark.catalog.tableExists(name_or_path)
