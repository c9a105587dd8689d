"""Results, tables, indexes and models as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.sources.tables import to_tbl_layout


def write_table(df: DataFrame, path: str) -> None:
    """Parquet."""
    df.write.mode("overwrite").parquet(path)


def text_line(*columns: str) -> Column:
    """Columns as text between tabs; a null shows as ``null``."""
    return F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])


def write_text(df: DataFrame, path: str) -> None:
    """One line per row with a tab between the columns."""
    df.select(text_line(*df.columns).alias("value")).write.mode("overwrite").text(path)


def write_sorted(df: DataFrame, path: str, *keys: str) -> None:
    """Text in the order of the keys: the files in order, and the lines in each file."""
    write_text(df.orderBy(*keys), path)


def write_minutes(df: DataFrame, path: str, line: str, minute: str) -> None:
    """Lines as text files of a minute each, ``part-<n>-<minute>``, in one flat directory.

    The times of the files are as far apart as the minutes, so a stream over the directory takes them in their order. Lines
    of a minute are dealt to one file per task that has some. The driver names the files, one by one: minutes of a day.
    """
    staged = f"{path}/_staged"
    rows = df.select(F.col(line).alias("value"), F.col(minute).cast("int").alias("minute"))
    rows.repartition("minute").write.mode("overwrite").partitionBy("minute").text(staged)
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path
    files = folder(path).getFileSystem(spark._jsc.hadoopConfiguration())
    begun = files.getFileStatus(folder(staged)).getModificationTime()
    for place in files.globStatus(folder(f"{staged}/minute=*")):
        number = int(place.getPath().getName().removeprefix("minute="))
        for nth, part in enumerate(files.globStatus(folder(f"{place.getPath()}/part-*"))):
            # Fixed value: the names of the files of a replayed collection.
            named = folder(f"{path}/part-{nth}-{number:05d}")
            files.rename(part.getPath(), named)
            files.setTimes(named, begun + 1000 * number, -1)
    files.delete(folder(staged), True)


def write_tbl(df: DataFrame, directory: str, name: str) -> None:
    """A table as ``|``-delimited lines in the standard column order, each line ending in ``|``."""
    rows = to_tbl_layout(df, name).withColumn("_end", F.lit(""))
    (
        rows.write.mode("overwrite")
        .option("sep", "|")
        .option("quote", "")
        .option("emptyValue", "")
        .option("dateFormat", "yyyy-MM-dd")
        .csv(f"{directory}/{name}.tbl")
    )


def write_index(lists: DataFrame, path: str, partitions: int) -> None:
    """Posting lists laid out by term, so that a read of some terms skips the other row groups.

    Files hold ranges of terms and are sorted by term. A term's segments may fall into two files.
    """
    placed = lists.repartitionByRange(partitions, "term", "segment").sortWithinPartitions("term", "segment")
    placed.write.mode("overwrite").parquet(path)


def read_terms(index: DataFrame, terms: list[str]) -> DataFrame:
    """The posting lists of some terms; the filter reaches the scan."""
    return index.where(F.col("term").isin(terms))


def write_model(model: DataFrame, path: str) -> None:
    """``(model_id, feature, weight)`` as a table."""
    write_table(model.select("model_id", "feature", "weight"), path)


def write_text_model(model: DataFrame, path: str) -> None:
    """``(feature, weight)`` as lines ``(feature,weight)``."""
    # Fixed value: the text form of one weight.
    line = F.format_string("(%s,%s)", F.col("feature").cast("string"), F.col("weight").cast("string"))
    model.select(line.alias("value")).write.mode("overwrite").text(path)


def write_text_models(models: DataFrame, path: str) -> None:
    """Each model of ``(model_id, feature, weight)`` as a text file ``part-<number>`` of its own, models in order of their ids.

    A model is written by one task, line by line. The table of model ids is small: one row per file.
    """
    ids = models.select("model_id").distinct()
    numbers = ids.select("model_id", (F.row_number().over(Window.orderBy("model_id")) - 1).alias("_part"))
    placed = models.join(F.broadcast(numbers), "model_id").repartitionById(max(1, ids.count()), F.col("_part"))
    write_text_model(placed, path)
