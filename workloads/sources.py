"""Python sources that Spark derives from the given tables, one file per row.

The tables hold no Python code, so each row is written out as a small program
whose shape and positions depend on the row. One row per file keeps the number
of files, and so the work, in step with the table, and gathers nothing.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from treeloom.session import stage
from treeloom.sources import files

REPOSITORY = "workspace"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _written(df: DataFrame, path: Column, text: Column) -> DataFrame:
    """Sources of a table that is one file here; parsing it should keep all cores busy."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return files.sources_from_text(df, path, text, 4 * cores)


def _fill(template: str, values: dict[str, Column]) -> Column:
    """Text with each ``<name>`` replaced by the value of that name."""
    return reduce(
        lambda text, item: F.replace(text, F.lit(f"<{item[0]}>"), item[1].cast("string")),
        values.items(),
        F.lit(template),
    )


# --- ledger: a first assignment, then one line per unit of p_size -----------


def ledger_text() -> Column:
    lines = F.transform(
        F.sequence(F.lit(1), F.col("p_size")),
        lambda i: F.concat(F.lit("total = total + "), i.cast("string"), F.lit("\n")),
    )
    return F.concat(F.lit("total = 0\n"), F.array_join(lines, ""))


def ledger_path() -> Column:
    """Folders by brand and type, with names of all sorts the exclusion rule knows."""
    size = F.col("p_size")
    key = F.col("p_partkey").cast("string")
    folder = (
        F.when(F.col("p_type") == "ECONOMY", "tests")
        .when(F.col("p_type") == "PROMO", "test")
        .when(size == 49, ".git")
        .otherwise(F.lower("p_type"))
    )
    name = (
        F.when(size % 10 == 0, F.lit("setup.py"))
        .when(size % 10 == 1, F.lit("conf.py"))
        .when(size % 10 == 2, F.lit("test_ledger.py"))
        .when(size % 10 == 3, F.lit("ledger_test.py"))
        .when(size % 10 == 4, F.lit("latest.py"))
        .otherwise(F.concat(F.lit("ledger_"), key, F.lit(".py")))
    )
    brand = F.replace(F.col("p_brand"), F.lit("#"), F.lit("_"))
    # A module and a folder of one name, and a folder whose name goes on with a dash, stand
    # apart in the order of paths though not in that of texts.
    twin = F.when(F.col("p_partkey") % 3 == 0, F.concat(brand, F.lit("-x"))).otherwise(brand)
    return (
        F.when(size == 45, F.concat(F.lit("root_"), key, F.lit(".py")))
        .when(size == 46, F.concat(brand, F.lit("/"), folder, F.lit("/p"), key, F.lit(".py")))
        .otherwise(F.concat_ws("/", twin, folder, F.concat(F.lit("p"), key), name))
    )


def ledger_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = table(spark, sf_dir, "part").select(
        ledger_path().alias("rel_path"), F.octet_length(ledger_text()).alias("size_bytes")
    )
    return files.listing(entries)


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit(f"{REPOSITORY}/ledger/"), F.col("p_partkey").cast("string"), F.lit(".py"))
    return _written(table(spark, sf_dir, "part"), path, ledger_text())


# --- routines: functions, classes and calls, named after a customer ---------

ROUTINES = """@trace(<key>)
def f_<key>(a, b=seed()):
    t = a
    def inner():
        return t
    return inner()
def f_<key>():
    pass
class C_<nation>:
    def m(self):
        return f_<key>(self.<segment>)
C_<nation>().m()
f_<key>(<key>)
(lambda: 0)()
"""


def routines_rows(customers: DataFrame, head: str = "", tail: str = "") -> DataFrame:
    path = F.concat(F.lit(f"{REPOSITORY}/routines/"), F.col("c_custkey").cast("string"), F.lit(".py"))
    text = _fill(
        ROUTINES,
        {
            "key": F.col("c_custkey"),
            "nation": F.col("c_nationkey"),
            "segment": F.col("c_mktsegment"),
        },
    )
    return _written(customers, path, F.concat(F.lit(head), text, F.lit(tail)))


def routines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routines_rows(table(spark, sf_dir, "customer"))


def _debtors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0)


def routines_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in debt again, each with a remark at the end, which moves nothing."""
    return routines_rows(_debtors(spark, sf_dir), tail="# in debt\n")


def routines_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in debt again, each with a remark at the start."""
    return routines_rows(_debtors(spark, sf_dir), head="# in debt\n")


# --- branches: every kind of block, moved down by the order's priority ------

BRANCHES = """if <key> > <customer>:
    x = 1
    y = x
elif <key> == <customer>:
    x = 2
else:
    while x:
        x = x - 1
    with open(<key>) as h:
        h.read()
        h.close()
try:
    a = x
    b = a
except ValueError as e:
    c = 1
    d = c
finally:
    z = 0
    w = z
match <key>:
    case 1:
        m = 1
        n = m
async def g_<status>():
    async for i in src:
        j = i
        k = j
p = [q for q in r]
s = [f(u(t)) for t in r]
v = a.b.c
"""


def branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit(f"{REPOSITORY}/branches/"), F.col("o_orderkey").cast("string"), F.lit(".py"))
    remarks = F.repeat(F.lit("# priority\n"), F.left("o_orderpriority", F.lit(1)).cast("int"))
    program = _fill(
        BRANCHES,
        {
            "key": F.col("o_orderkey"),
            "customer": F.col("o_custkey"),
            "status": F.col("o_orderstatus"),
        },
    )
    return _written(
        table(spark, sf_dir, "orders"), path, F.concat(remarks, program)
    )


def write_tree(rows: DataFrame, root: str) -> DataFrame:
    """Write sources as files below a shared folder, by tasks; the number of files."""
    prefix = len(REPOSITORY) + 1

    def run(batches):
        filesystem, base = fs.FileSystem.from_uri(root)
        made = set()
        for frame in batches:
            for path, content in zip(frame["file_path"], frame["content"], strict=True):
                target = f"{base}/{path[prefix:]}"
                folder = target.rpartition("/")[0]
                if folder not in made:
                    filesystem.create_dir(folder, recursive=True)
                    made.add(folder)
                with filesystem.open_output_stream(target, compression=None) as out:
                    out.write(content)
            yield pd.DataFrame({"files": [len(frame)]})

    done = rows.select("file_path", "content").mapInPandas(run, "files long")
    return stage(done.agg(F.sum("files").alias("files")), "written")


# --- prose: documents as they are, none of which is Python ------------------


def prose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; those in French end in a byte that is not UTF-8."""
    path = F.concat(F.lit(f"{REPOSITORY}/prose/"), F.col("doc_id").cast("string"), F.lit(".py"))
    content = F.encode("text", "utf-8")
    stray = F.when(F.col("lang") == "fr", F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit("")))
    return _written(
        table(spark, sf_dir, "documents"), path, F.concat(content, stray)
    )


def mended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The German documents of ``prose`` once more, as Python that parses."""
    path = F.concat(F.lit(f"{REPOSITORY}/prose/"), F.col("doc_id").cast("string"), F.lit(".py"))
    german = table(spark, sf_dir, "documents").filter(F.col("lang") == "de")
    text = F.concat(F.lit("# "), F.replace(F.col("text"), F.lit("\n"), F.lit("\n# ")), F.lit("\ndone = 1\n"))
    return _written(german, path, text)


def quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as Python: one assignment, then the whole text as remarks.

    Lines end as is usual on three kinds of systems, depending on the language.
    """
    path = F.concat(F.lit(f"{REPOSITORY}/quoted/"), F.col("doc_id").cast("string"), F.lit(".py"))
    end = F.when(F.col("lang") == "de", "\r\n").when(F.col("lang") == "es", "\r").otherwise("\n")
    text = F.concat(
        F.lit("doc = "),
        F.col("doc_id").cast("string"),
        F.lit("\n# "),
        F.replace(F.col("text"), F.lit("\n"), F.lit("\n# ")),
    )
    return _written(
        table(spark, sf_dir, "documents"), path, F.replace(text, F.lit("\n"), end)
    )
