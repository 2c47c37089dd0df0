"""CSV feed files derived from ``orders``: one per feed, order year and key range, each year of a
feed with its own defect. The SQL twin is ``sql_gate``.

year   patient_admissions           treatment_records            insurance_claims
1995   clean                        clean                        clean
1996   last column missing          optional column renamed      clean
1997   required column renamed      columns reordered            blank amounts of pending claims
1998   doctor missing in 1 of 7     extra column                 zero-byte file
1999   text in a numeric column     blank costs                  header only
2000   rows repeated                rows one cell short          dates before the allowed range
2001   bad codes, ragged rows       bad codes                    lower-case codes
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.feeds import ADMISSIONS, CLAIMS, TREATMENTS
from wardline.registry.adapters import _padded, read
from wardline.session import scratch_path
from wardline.sources import files

# Fixed values shared with the SQL side.
KEYS_PER_FILE = 10_000_000
SHIFT_MONTHS = 300
UPLOADED = "2026-06-29 12:00:00"


def _joined(*cells: Column, more: tuple[Column, ...] = ()) -> Column:
    """Cells with blanks for NULL; a NULL among ``more`` leaves that cell out."""
    return F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in cells], *more)


def _header(names: list[str]) -> str:
    return ",".join(names)


def _swap(names: list[str], old: str, new: str) -> list[str]:
    return [new if n == old else n for n in names]


TREATMENT_SWAPPED = ["treatment_id", "admission_id", "doctor_id", "procedure_code", "treatment_date", "outcome", "cost"]

HEADERS: dict[str, dict[int, str]] = {
    "patient_admissions": {
        1996: _header(ADMISSIONS.columns[:-1]),
        1997: _header(_swap(ADMISSIONS.columns, "patient_id", "pat_id")),
        0: " " + _header([c.upper() for c in ADMISSIONS.columns]),
    },
    "treatment_records": {
        1996: _header(_swap(TREATMENTS.columns, "cost", "price")),
        1997: _header(TREATMENT_SWAPPED),
        1998: _header([*TREATMENTS.columns, "note"]),
        0: _header(TREATMENTS.columns),
    },
    "insurance_claims": {0: _header(CLAIMS.columns)},
}


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    day = F.col("o_orderdate")
    return o.withColumns(
        {
            "k": F.col("o_orderkey"),
            "y": F.year(day),
            "part": F.floor(F.col("o_orderkey") / KEYS_PER_FILE).cast("long"),
            "iso": F.date_format(F.add_months(day.cast("date"), SHIFT_MONTHS), "yyyy-MM-dd"),
            "dmy": F.date_format(F.add_months(day.cast("date"), SHIFT_MONTHS), "dd/MM/yyyy"),
            "price": F.col("o_totalprice").cast("decimal(12,2)"),
        }
    )


def _data(base: DataFrame, feed: str, line: Column, copies: Column | None = None) -> DataFrame:
    name = F.concat_ws("_", F.lit(feed), F.col("y").cast("string"), F.concat(F.col("part").cast("string"), F.lit(".csv")))
    out = base.select(name.alias("file_name"), "y", "k", line.alias("line"), *([copies.alias("n")] if copies is not None else []))
    if copies is not None:
        out = out.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n")))).withColumn("k", F.col("k") * 2 + F.col("i"))
    return out.select("file_name", "y", (F.col("k") + 1).alias("line_no"), "line")


def _admission_lines(b: DataFrame) -> DataFrame:
    k, y = F.col("k"), F.col("y")
    doctor = F.concat(F.lit("D"), _padded(k % 10, 3))
    doctor = F.when((y == 1998) & (k % 14 == 0), "NULL").when((y == 1998) & (k % 7 == 0), "").otherwise(doctor)
    kind = F.element_at(F.array(F.lit("EMG"), F.lit(" URG "), F.lit("ELC")), (k % 3 + 1).cast("int"))
    cells = [
        k,
        F.col("o_custkey"),
        doctor,
        F.when(k % 40 == 0, "").otherwise(F.concat(F.lit("H"), _padded(k % 25, 2))),
        F.when((y == 2001) & (k % 31 == 0), "1999-12-31").when(k % 3 == 0, F.col("dmy")).otherwise(F.col("iso")),
        F.substring("o_orderpriority", 3, 3),
        F.when((y == 2001) & (k % 17 == 0), "XXX").otherwise(kind),
        F.when(k % 23 == 0, F.concat(F.lit('"D,'), k % 10, F.lit('"'))).otherwise(F.concat(F.lit("D"), k % 40)),
        F.when((y == 1999) & (k % 11 == 0), "abc").otherwise((k % 12).cast("string")),
    ]
    flag = F.when(y != 1996, (k % 2).cast("string"))
    line = _joined(*cells, more=(flag, F.when((y == 2001) & (k % 19 == 0), "x")))
    copies = F.when((y == 2000) & (k % 13 == 0), 2).otherwise(1)
    return _data(b, ADMISSIONS.name, line, copies)


def _treatment_lines(b: DataFrame) -> DataFrame:
    k, y = F.col("k"), F.col("y")
    outcome = F.element_at(F.array(F.lit("P"), F.lit("F"), F.lit("S")), (k % 3 + 1).cast("int"))
    outcome = F.when((y == 2001) & (k % 9 == 0), "X").otherwise(outcome)
    cost = F.when((y == 1999) & (k % 20 == 0), "").otherwise(F.col("price").cast("string"))
    lead = [k, k, F.concat(F.lit("D"), _padded(k % 10, 3)), F.concat(F.lit("P"), k % 25), F.col("iso")]
    turned = y == 1997
    sixth = F.when(turned, outcome).otherwise(cost)
    seventh = F.when(turned, cost).when(y != 2000, outcome)
    line = _joined(*lead, sixth, more=(seventh, F.when(y == 1998, "n")))
    return _data(b, TREATMENTS.name, line)


def _claim_lines(b: DataFrame) -> DataFrame:
    k, y, status = F.col("k"), F.col("y"), F.col("o_orderstatus")
    code = F.when(status == "F", "A").when(status == "O", "R").otherwise("P")
    approved = F.when((y == 1997) & (status == "P"), "").when(status == "F", F.col("price").cast("string")).otherwise("0")
    line = _joined(
        k,
        k,
        F.concat(F.lit("I"), _padded(k % 5 + 1, 2)),
        F.col("price"),
        approved,
        F.when((y == 2001) & (k % 8 == 0), F.lower(code)).otherwise(code),
        F.when((y == 2000) & (k % 5 == 0), "2019-12-31").otherwise(F.col("iso")),
        F.when(status == "P", "").otherwise(F.col("iso")),
    )
    return _data(b.filter(~y.isin(1998, 1999)), CLAIMS.name, line)


def _header_lines(b: DataFrame) -> DataFrame:
    """One header per file; derived from the file's rows, counted down before the shuffle."""
    files = b.select("y", "part").distinct()
    out = None
    for feed, by_year in HEADERS.items():
        text = F.lit(by_year[0])
        for year, other in by_year.items():
            if year:
                text = F.when(F.col("y") == year, other).otherwise(text)
        name = F.concat_ws("_", F.lit(feed), F.col("y").cast("string"), F.concat(F.col("part").cast("string"), F.lit(".csv")))
        some = files.select(name.alias("file_name"), "y", F.lit(0).cast("long").alias("line_no"), text.alias("line"))
        if feed == CLAIMS.name:
            some = some.filter("y <> 1998")
        out = some if out is None else out.unionByName(some)
    return out


_tables: dict[tuple[str, str], str] = {}


def gate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived lines, written once per session and folder: what has arrived."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _tables:
        path = scratch_path(spark, "gate-lines")
        derived_lines(spark, sf_dir).write.parquet(path)
        _tables[at] = path
    return spark.read.parquet(_tables[at])


def derived_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as a text source would give them: file, upload time, place, text."""
    b = _base(spark, sf_dir)
    data = _admission_lines(b).unionByName(_treatment_lines(b)).unionByName(_claim_lines(b))
    return data.unionByName(_header_lines(b)).select(
        "file_name",
        F.lit(UPLOADED).cast("timestamp_ntz").alias("upload_dttm"),
        F.lit(0).cast("long").alias("block_start"),
        "line_no",
        "line",
    )


def gate_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File sizes: the bytes of the lines and their line ends; claims of 1998 are empty files."""
    sized = gate_lines(spark, sf_dir).groupBy("file_name").agg(F.sum(F.octet_length("line") + 1).alias("size"))
    return sized.unionByName(_empty_files(spark, sf_dir).withColumn("size", F.lit(0).cast("long")))


def _empty_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    empty = _base(spark, sf_dir).filter("y = 1998").select("part").distinct()
    name = F.concat(F.lit(f"{CLAIMS.name}_1998_"), F.col("part").cast("string"), F.lit(".csv"))
    return empty.select(name.alias("file_name"))


def write_files(spark: SparkSession, sf_dir: str) -> str:
    """The same files in a new scratch folder.

    Spark writes each file's lines in order under a folder of its name; the finished part is then
    renamed to the file name, which moves metadata only. A file has at most KEYS_PER_FILE orders.
    The lines are derived on their way into the files; ``gate_lines`` is for those who read them as a table.
    """
    root = scratch_path(spark, "incoming")
    lines = derived_lines(spark, sf_dir).select("file_name", "line_no", F.col("line").alias("value"))
    spread = lines.repartition("file_name").sortWithinPartitions("file_name", "line_no").drop("line_no")
    spread.write.partitionBy("file_name").text(f"{root}/parts")
    jvm = spark._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    incoming = Path(f"{root}/incoming")
    fs.mkdirs(incoming)
    for folder in fs.listStatus(Path(f"{root}/parts")):
        name = folder.getPath().getName()
        if name.startswith("file_name="):
            parts = [p.getPath() for p in fs.listStatus(folder.getPath()) if p.getPath().getName().startswith("part-")]
            if len(parts) != 1:
                raise RuntimeError(f"{name}: {len(parts)} parts")
            fs.rename(parts[0], Path(incoming, name.split("=", 1)[1]))
    for r in _empty_files(spark, sf_dir).toLocalIterator():
        fs.create(Path(incoming, r[0])).close()
    return incoming.toString()


def read_folder(spark: SparkSession, sf_dir: str, store: bool = True) -> tuple[DataFrame, DataFrame]:
    """Headers and records of the files as they lie in the folder."""
    return files.read_files(files.read_lines(spark, incoming(spark, sf_dir)), store)


_folders: dict[tuple[str, str], str] = {}


def incoming(spark: SparkSession, sf_dir: str) -> str:
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _folders:
        _folders[at] = write_files(spark, sf_dir)
    return _folders[at]
