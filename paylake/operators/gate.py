"""The read-only SQL gate and named aliases over Parquet paths."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce

from py4j.java_gateway import is_instance_of
from pyspark.sql import DataFrame, SparkSession

_ALIAS = re.compile(r"[A-Za-z][A-Za-z0-9_]*")

# Pieces of a text that are not code: quoted text, quoted names and comments.
_QUOTED = r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|`[^`]*`|--[^\n]*|/\*.*?\*/"""
_NOT_CODE = re.compile(_QUOTED, re.S)
_PATH = r"'(?:[^'])*'"
_READ_CALL = re.compile(
    rf"\bread_parquet\s*\(\s*({_PATH}|\[\s*{_PATH}(?:\s*,\s*{_PATH})*\s*\])((?:\s*,\s*\w+\s*=\s*\w+)*)\s*\)|({_QUOTED})", re.S | re.I
)

# Spark reads these keywords as a table alias and would run a plain join.
_OTHER_JOIN = re.compile(r"\b(asof|positional)\s+((left|right|full|inner)\s+)?(outer\s+)?join\b", re.I)

# What an analysed query must not hold, by class: programs, calls into the JVM, and anything that is not read as Parquet.
_PROGRAMS = {"ScriptTransformation", "ScriptInputOutputSchema"}
_JVM_CALLS = {"CallMethodViaReflection", "TryReflect", "Reflect"}
_OTHER_RELATIONS = {"DataSourceV2Relation", "DataSourceV2ScanRelation", "StreamingRelation", "StreamingRelationV2", "HiveTableRelation"}

# How a plan told as JSON names a node's class, and the classes that hold expressions in lists of lists, which it leaves out.
_CLASS = re.compile(r'"class":"([^"\\]+)"')
_NESTED = {"Expand", "Unpivot", "Pivot", "UnresolvedInlineTable"}


def _relation(root: str) -> str:
    return "parquet.`" + root.replace("`", "``") + "`"


def _tree(path: str) -> str:
    """A trailing `/**/*.parquet` means the whole tree with its partitions."""
    return re.sub(r"/\*\*(/\*(\.parquet)?)?\Z", "", path)


def _base(tree: str) -> str:
    """The folder above the first pattern or partition of a path, from where partition columns are read."""
    parts = tree.split("/")
    first = next((i for i, part in enumerate(parts) if re.search(r"[*?\[{]|=", part)), None)
    return tree if first is None else "/".join(parts[:first])


def _roots(spark: SparkSession, tree: str) -> list[str]:
    """The folders a pattern stands for; a path without one stands for itself."""
    if not re.search(r"[*?\[{]", tree):
        return [tree]
    pattern = spark._jvm.org.apache.hadoop.fs.Path(tree)
    found = pattern.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(pattern)
    if not found:
        raise ValueError(f"nothing matches {tree}")
    return sorted(status.getPath().toString() for status in found)


def _read(spark: SparkSession, paths: list[str], options: dict[str, str]) -> DataFrame:
    """Paths of one call. `union_by_name` merges the columns of all files; partitions are always columns."""
    unknown = set(options) - {"union_by_name", "hive_partitioning"}
    if unknown or options.get("hive_partitioning", "true") not in ("true", "1"):
        raise ValueError("read_parquet takes union_by_name, and hive_partitioning as true")
    merged = options.get("union_by_name", "false") in ("true", "1")
    # Folders below one base are one table, with the partitions in their names; other folders are tables of their own.
    tables: dict[str, list[str]] = {}
    for root in (root for path in paths for root in _roots(spark, _tree(path))):
        tables.setdefault(_base(root), []).append(root)
    parts = [
        spark.read.option("mergeSchema", merged).options(**({} if roots == [base] else {"basePath": base})).parquet(*roots)
        for base, roots in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=merged), parts)


def _with_paths(spark: SparkSession, sql: str) -> tuple[str, list[str]]:
    """`read_parquet(...)` in table position becomes a view of its own; returns the views too."""
    views: list[str] = []

    def replaced(match: re.Match) -> str:
        if match.group(1) is None:
            return match.group(3)
        options = dict(re.findall(r"(\w+)\s*=\s*(\w+)", match.group(2).lower()))
        views.append(f"paths_{uuid.uuid4().hex}")
        _read(spark, re.findall(r"'([^']*)'", match.group(1)), options).createOrReplaceTempView(views[-1])
        return views[-1]

    return _READ_CALL.sub(replaced, sql), views


def _each(seq) -> Iterator:
    iterator = seq.iterator()
    while iterator.hasNext():
        yield iterator.next()


def _nodes(gateway, plan) -> Iterator:
    """Every plan and expression node of an analysed plan, those of subqueries and common tables included."""
    waiting = [plan]
    while waiting:
        node = waiting.pop()
        yield node
        waiting.extend(_each(node.children()))
        if is_instance_of(gateway, node, "org.apache.spark.sql.catalyst.plans.QueryPlan"):
            waiting.extend(_each(node.expressions()))
        elif is_instance_of(gateway, node, "org.apache.spark.sql.catalyst.expressions.PlanExpression"):
            waiting.append(node.plan())


def _kinds(gateway, plan) -> set[str]:
    """The classes of all nodes. The plan tells them in one piece, and text of the query is escaped in it; expressions that
    are nested too deep for that are looked for node by node."""
    kinds = {name.rsplit(".", 1)[-1].rstrip("$").rsplit("$", 1)[-1] for name in _CLASS.findall(plan.toJSON())}
    if kinds & _NESTED:
        kinds |= {node.getClass().getSimpleName() for node in _nodes(gateway, plan)}
    return kinds


def _relations(plan) -> Iterator:
    """Stored tables of the plan and of its subqueries at any depth."""
    for part in (plan, *_each(plan.subqueriesAll())):
        for leaf in _each(part.collectLeaves()):
            if leaf.getClass().getSimpleName() == "LogicalRelation":
                yield leaf.relation()


def _refuse(gateway, plan) -> None:
    """Look at what was understood, not at how it was written: names can be spelled or computed in many ways."""
    kinds = _kinds(gateway, plan)
    if kinds & _PROGRAMS:
        raise ValueError("a query cannot start programs")
    if kinds & _JVM_CALLS:
        raise ValueError("a query cannot call JVM code")
    if kinds & _OTHER_RELATIONS:
        raise ValueError("only Parquet tables can be read")
    for relation in _relations(plan):
        if relation.getClass().getSimpleName() != "HadoopFsRelation" or relation.fileFormat().getClass().getSimpleName() != "ParquetFileFormat":
            raise ValueError("only Parquet tables can be read")


def run_query(spark: SparkSession, sql: str) -> DataFrame:
    """Run one SELECT or WITH text. The result is a DataFrame; nothing is collected here.

    The text is placed in parentheses after `SELECT * FROM`, where only a query is grammatical: a write, a
    setting or a second statement is refused by the parser. What the analyser made of it is then searched for
    programs, JVM calls and files of other formats, before anything runs.
    """
    text = sql.strip().rstrip(";").rstrip()
    code = _NOT_CODE.sub(" ", text)
    if not re.match(r"\s*\(*\s*(select|with)\b", code, re.I):
        raise ValueError("the gate takes one SELECT or WITH text")
    if _OTHER_JOIN.search(code):
        raise ValueError("ASOF and POSITIONAL joins are not part of this dialect; see asof_join")
    text, views = _with_paths(spark, text)
    try:
        result = spark.sql(f"SELECT * FROM (\n{text}\n)")
    finally:
        for view in views:
            spark.catalog.dropTempView(view)
    _refuse(spark.sparkContext._gateway, result._jdf.queryExecution().analyzed())
    return result


def register_alias(spark: SparkSession, name: str, path: str) -> None:
    """Name a Parquet path, as a view `name` and as a table function `name()`.

    Both list the files anew for every query. The columns, and the folders a pattern stands for, are those found now;
    register again after they change. A column that some of the folders lack is NULL for those.
    """
    if not _ALIAS.fullmatch(name):
        raise ValueError("an alias starts with a letter and has letters, digits and underscores only")
    found = {root: spark.sql(f"SELECT * FROM {_relation(root)}").schema for root in _roots(spark, _tree(path))}
    kinds = {field.name: field.dataType.simpleString() for schema in found.values() for field in schema.fields}
    quoted = {column: "`" + column.replace("`", "``") + "`" for column in kinds}

    def part(root: str) -> str:
        own = set(found[root].names)
        values = [quoted[c] if c in own else f"CAST(NULL AS {kind}) AS {quoted[c]}" for c, kind in kinds.items()]
        return f"SELECT {', '.join(values)} FROM {_relation(root)}"

    text = " UNION ALL ".join(part(root) for root in found)
    columns = ", ".join(f"{quoted[column]} {kind}" for column, kind in kinds.items())
    spark.sql(f"CREATE OR REPLACE TEMP VIEW {name} AS {text}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}() RETURNS TABLE ({columns}) RETURN {text}")
