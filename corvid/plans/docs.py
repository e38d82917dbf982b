"""Queries of docstrings and sizes of files that Spark writes out of the parts; their SQL states what was read off the texts by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.plans import code_facts
from corvid.sources import contracts, docstrings

#: Files in three styles; % stands for the part's size.
_FIELDS = '''"""Module of %."""
def run(a, n):
    """Run it.

    More about
    it.

    :param int a: how many, defaults to %.
    :param n: which,
        may be none
    :type n: str
    :returns: the sum
    :rtype: int
    :raises ValueError: never
    """
    return a
'''
_TITLED = '''class Box:
    """A box of %.

    Attributes:
        size (int): Its size.
    """
    def put(self, x):
        """Put x.

        Args:
            x (str, optional): What. Defaults to %.
            y: required
                always

        Returns:
            bool: whether None was met

        Raises:
            KeyError: if full

        Example:
            put(1)
        """
'''
_UNDERLINED = '''def f(a, b):
    """
    Do f
    on %.

    Parameters
    ----------
    a : int
        First.
    b

    Returns
    -------
    str
        Text of %.

    Raises
    ------
    OSError
    """
def g():
    pass
'''


def files(spark, d) -> DataFrame:
    """path, text: a file for each part, of a kind by its key."""
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    text = F.when(key % 3 == 0, _FIELDS).when(key % 3 == 1, _TITLED).otherwise(_UNDERLINED)
    return spark.read.parquet(f"{d}/part.parquet").select(F.concat(F.lit("src/p"), key.cast("string"), F.lit(".py")).alias("path"), F.replace(text, F.lit("%"), size).alias("text"))


def _part(df: DataFrame) -> DataFrame:
    return df.withColumn("part", F.regexp_extract("path", r"p(\d+)\.py", 1).cast("long"))


def docstring_rows(spark, d) -> DataFrame:
    """Docstrings of all files with their parts, as text."""
    said = lambda c, *fields: F.array_join(F.transform(c, lambda x: F.concat_ws(":", *[F.coalesce(F.replace(x[f], F.lit("\n"), F.lit("/")), F.lit("-")) for f in fields])), ";")
    none = lambda c: F.coalesce(F.replace(F.col(c), F.lit("\n"), F.lit("/")), F.lit("-"))
    rows = _part(docstrings.docstrings(files(spark, d)))
    return rows.select(
        "part", "module", "qualname", "kind", none("short").alias("short"), none("long").alias("long"), said("params", "name", "type", "text", "default").alias("params"),
        F.concat_ws(":", none("returns.type"), none("returns.text")).alias("returns"), said("raises", "type", "text").alias("raises"), F.array_join("examples", ";").alias("examples"),
    )


def documented_contracts(spark, d) -> DataFrame:
    """What docstrings say of parameters and results that may be None."""
    texts = files(spark, d)
    rows = _part(contracts.function_contracts(texts, docstrings.contract_docs(docstrings.docstrings(texts))))
    told = F.array_join(F.array_sort(F.transform(F.map_entries("param_nullability"), lambda e: F.concat_ws(":", e["key"], e["value"]))), ",")
    return rows.select("part", "qualname", told.alias("params"), F.coalesce("return_nullability", F.lit("-")).alias("result"), F.round("confidence", 3).alias("confidence"))


def file_sizes(spark, d) -> DataFrame:
    """Nodes, depths and shares of annotations of all files."""
    rows = _part(docstrings.file_metrics(code_facts.files(spark, d)))
    cols = ("nodes", "functions", "classes", "complexity", "untyped_defs")
    return rows.select("part", *cols, F.round("avg_depth", 8).alias("avg_depth"), F.col("max_depth").cast("long").alias("max_depth"), F.round("params_ratio", 8).alias("params_ratio"), F.round("returns_ratio", 8).alias("returns_ratio"))


QUERIES = {f.__name__: f for f in (docstring_rows, documented_contracts, file_sizes)}

ORACLES = {
    "docstring_rows": """SELECT p_partkey AS part, 'src.p' || p_partkey AS module, qualname, kind, replace(short, '%', CAST(p_size AS VARCHAR)) AS short, replace("long", '%', CAST(p_size AS VARCHAR)) AS "long", replace(params, '%', CAST(p_size AS VARCHAR)) AS params,
        replace(returns, '%', CAST(p_size AS VARCHAR)) AS returns, raises, examples FROM part JOIN (VALUES
        (0, '', 'module', 'Module of %.', '-', '', '-:-', '', ''),
        (0, 'run', 'function', 'Run it.', 'More about/it.', 'a:int:how many, defaults to %.:%;n:str:which,/may be none:-', 'int:the sum', 'ValueError:never', ''),
        (1, 'Box', 'class', 'A box of %.', '-', 'size:int:Its size.:-', '-:-', '', ''),
        (1, 'Box.put', 'method', 'Put x.', '-', 'x:str:What. Defaults to %.:%;y:-:required/always:-', 'bool:whether None was met', 'KeyError:if full', 'put(1)'),
        (2, 'f', 'function', 'Do f', 'on %.', 'a:int:First.:-;b:-:-:-', 'str:Text of %.', 'OSError:-', ''))
        v(k, qualname, kind, short, "long", params, returns, raises, examples) ON p_partkey % 3 = k""",
    "documented_contracts": """SELECT p_partkey AS part, v.* EXCLUDE (k) FROM part JOIN (VALUES
        (0, 'run', 'a:unknown,n:nullable', '-', 0.3::DOUBLE), (1, 'Box.put', 'x:unknown', 'nullable', 0.3), (2, 'f', 'a:unknown,b:unknown', '-', 0.3), (2, 'g', '', '-', 0.0))
        v(k, qualname, params, result, confidence) ON p_partkey % 3 = k""",
    "file_sizes": """SELECT p_partkey AS part, v.* EXCLUDE (k) FROM part JOIN (VALUES
        (0, 63::BIGINT, 1::BIGINT, 0::BIGINT, 0::BIGINT, 1::BIGINT, 4.93650794::DOUBLE, 9::BIGINT, 0.0::DOUBLE, 0.0::DOUBLE), (1, 57, 2, 0, 0, 2, 4.9122807, 9, 0.0, 0.0), (2, 77, 2, 1, 2, 2, 5.23376623, 9, 0.0, 0.0), (3, 26, 2, 0, 0, 2, 4.5, 7, 0.0, 0.0))
        v(k, nodes, functions, classes, complexity, untyped_defs, avg_depth, max_depth, params_ratio, returns_ratio) ON p_partkey % 4 = k""",
}
