"""Schemas that change from file to file: least-cost edit scripts between them, and one table out of all files."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.names import renamed
from tapeloom.session import materialize, small

#: Files of a batch whose order is worked out together.
SEQ_BLOCK = 4096
#: Different names, and columns of the one table, that the driver knows at most; more raise ValueError.
MAX_NAMES = 2_000

# Edit costs. A column that goes on under its name costs nothing, a removal or an addition 1 for each node of the tree, so a rename
# is only in the script if it is cheaper than a removal with an addition.
REMOVE = ADD = 1.0
RETYPE = 0.05
RENAME_BY_VALUES, RENAME_BY_ROUNDED_VALUES, RENAME_BY_NAME, MOVE, NEVER = 0.2, 0.5, 0.8, 0.6, 1e6

_BLANK = ("", "-", "--", "null", "none", "nan", "n/a")
_NUMBER = re.compile(r"[+-]?(\d[\d,]*)?\.?\d+(e[+-]?\d+)?", re.I)
_DATE = re.compile(r"(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})([ T].*)?")
_CODE = re.compile(r"(?:(?:SH|SZ|BJ)[._]?)?(\d{6})(?:[._](?:SH|SZ|BJ))?", re.I)


def plain_name(name: str) -> str:
    """A column's name without marks, blanks, case and the suffix ``_raw``."""
    text = name.replace("﻿", "").strip().lower()
    return text[:-4] if text.endswith("_raw") else text


def plain_value(value: object) -> float | str | None:
    """A value in a form that survives another type or format: numbers, dates (as YYYYMMDD) and codes as numbers, blanks as None."""
    if value is None or isinstance(value, (bool, int, float)):
        return None if value is None or value != value else float(value)
    text = str(value).strip()
    if text.lower() in _BLANK:
        return None
    if text.lower() in ("true", "false"):
        return float(text.lower() == "true")
    if m := _DATE.fullmatch(text):
        return float(int(m[1]) * 10000 + int(m[2]) * 100 + int(m[3]))
    if m := _CODE.fullmatch(text):
        return float(m[1])
    if _NUMBER.fullmatch(text):
        return float(text.replace(",", ""))
    return text


def _split_fields(text: str) -> list[str]:
    """Split at the commas that are outside of all brackets."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(text):
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            out.append(text[start:i])
            start = i + 1
    return [x for x in (*out, text[start:]) if x.strip()]


class Node:
    """A field of a schema with the fields below it; lists and structs are opened, everything else is a leaf."""

    __slots__ = ("name", "kind", "children", "size")

    def __init__(self, name: str, type_text: str):
        text, low = type_text.strip(), type_text.strip().lower()
        self.name, self.kind, self.children = name, text, []
        if low.startswith("struct<") and text.endswith(">"):
            self.kind = "struct"
            self.children = [Node(*(x.strip() for x in f.split(":", 1))) for f in _split_fields(text[7:-1]) if ":" in f]
        elif low.startswith(("array<", "list<")) and text.endswith(">"):
            self.kind, self.children = "array", [Node("element", text[text.index("<") + 1 : -1])]
        self.size = 1 + sum(c.size for c in self.children)


def assign(cost: np.ndarray) -> list[int]:
    """Least-cost assignment of rows to columns (rows <= columns), by shortest augmenting paths."""
    n, m = cost.shape
    u, v, match, way = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        low, used = np.full(m + 1, math.inf), np.zeros(m + 1, bool)
        while True:
            used[j0] = True
            reduced = cost[match[j0] - 1] - u[match[j0]] - v[1:]
            better = ~used[1:] & (reduced < low[1:])
            low[1:][better], way[1:][better] = reduced[better], j0
            j1 = int(np.argmin(np.where(used, math.inf, low)))
            step = low[j1]
            u[match[used]] += step
            v[used] -= step
            low[~used] -= step
            j0 = j1
            if match[j0] == 0:
                break
        while j0:
            match[j0] = match[way[j0]]
            j0 = way[j0]
    out = [-1] * n
    for j in range(1, m + 1):
        if match[j]:
            out[match[j] - 1] = j - 1
    return out


def edit(before: list[Node], after: list[Node], rename_cost, at: str = "", was: str = "") -> tuple[float, list[tuple[str, str, str]]]:
    """Least-cost script between two unordered forests: (cost, steps of (kind, path before, path after)).

    Kinds: added, removed, renamed, retyped, kept. Children of matched nodes are matched below them, by the same rule, so the whole is a
    tree edit distance in which a node's descendants stay below it; :func:`moves` turns removed and added leaves that carry on under
    another parent into moves. The order of columns costs nothing.
    """
    n, m = len(before), len(after)
    if not n or not m:
        steps = [("removed", was + x.name, "") for x in before] + [("added", "", at + x.name) for x in after]
        return REMOVE * sum(x.size for x in before) + ADD * sum(x.size for x in after), steps
    names = {x.name: j for j, x in enumerate(after)}
    fixed = {i: names[x.name] for i, x in enumerate(before) if x.name in names}  # the same name always costs least
    steps: list[tuple[str, str, str]] = []
    total = 0.0

    def pair(x: Node, y: Node) -> tuple[float, list[tuple[str, str, str]]]:
        own, out = 0.0, []
        if x.name != y.name:
            own += rename_cost(was + x.name, at + y.name, x, y)
            out.append(("renamed", was + x.name, at + y.name))
        else:
            out.append(("kept", was + x.name, at + y.name))
        if x.kind != y.kind:
            own += RETYPE
            out.append(("retyped", was + x.name, at + y.name))
        below, more = edit(x.children, y.children, rename_cost, f"{at}{y.name}.", f"{was}{x.name}.") if x.children or y.children else (0.0, [])
        return own + below, out + more

    for i, j in fixed.items():
        cost, out = pair(before[i], after[j])
        total, steps = total + cost, steps + out
    left = [i for i in range(n) if i not in fixed]
    right = [j for j in range(m) if j not in set(fixed.values())]
    if left or right:
        size = len(left) + len(right)
        matrix, scripts = np.zeros((size, size)), {}
        for a, i in enumerate(left):
            matrix[a, :] = REMOVE * before[i].size
            for b, j in enumerate(right):
                matrix[a, b], scripts[a, b] = pair(before[i], after[j])
        for b, j in enumerate(right):
            matrix[len(left) :, b] = ADD * after[j].size
        chosen = assign(matrix)
        for a, b in enumerate(chosen):
            total += matrix[a, b]
            if a < len(left) and b < len(right):
                steps += scripts[a, b]
            elif a < len(left):
                steps.append(("removed", was + before[left[a]].name, ""))
            elif b < len(right):
                steps.append(("added", "", at + after[right[b]].name))
    return total, steps


def moves(steps: list[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    """Steps in which a removed and an added field of the same last name under different parents are one move, which costs less."""
    gone = {s[1].rpartition(".")[2]: s for s in steps if s[0] == "removed"}
    out, used = [], set()
    for s in steps:
        name = s[2].rpartition(".")[2]
        old = gone.get(name) if s[0] == "added" else None
        if old and MOVE < REMOVE + ADD and old not in used:
            used.add(old)
            out.append(("moved", old[1], s[2]))
        else:
            out.append(s)
    return [s for s in out if s not in used]


def overlap(tail: list[dict], head: list[dict]) -> list[tuple[dict, dict]]:
    """The records that end one file and open the next, in pairs: the longest run in which the records have most values in common.

    Values are compared as sets, rounded to whole numbers and without flags, so neither names nor formats matter.
    """

    def values(record: dict) -> set:
        plain = (plain_value(v) for v in record.values())
        return {round(v) if isinstance(v, float) else v for v in plain if v is not None and v not in (0.0, 1.0)}

    def alike(x: set, y: set) -> bool:
        return bool(x & y) and 2 * len(x & y) >= min(len(x), len(y))

    before, after = [values(r) for r in tail], [values(r) for r in head]
    best = 0
    for k in range(1, min(len(tail), len(head)) + 1):
        at = len(before) - k
        if all(alike(before[at + i], after[i]) for i in range(k)):
            best = k
    return list(zip(tail[-best:], head[:best])) if best else []


def _agree(x: float | str, y: float | str) -> float:
    """1 if equal but for format, 0.5 if equal after rounding one of them to a whole number, else 0."""
    if isinstance(x, float) and isinstance(y, float):
        if abs(x - y) <= 1e-5 * max(abs(x), abs(y), 1e-3):
            return 1.0
        return 0.5 if (x.is_integer() or y.is_integer()) and abs(x - y) < 1 else 0.0
    return float(x == y)


def rename_by_evidence(pairs: list[tuple[dict, dict]], called: dict[str, str] | None = None):
    """Cost of a rename: low where the values of both names agree on all overlapping records; where there are no values to compare, names
    that differ in marks, case or the suffix ``_raw`` alone count as one, and so do those that ``called`` gives the same name, as values
    proved it in other files. Names never stand against values."""
    called = called or {}

    def cost(old: str, new: str, x: Node, y: Node) -> float:
        a, b = plain_name(x.name), plain_name(y.name)
        alike = called.get(a, a) == called.get(b, b)
        seen = [(plain_value(a.get(old)), plain_value(b.get(new))) for a, b in pairs]
        seen = [(p, q) for p, q in seen if p is not None and q is not None]
        if not seen:
            return RENAME_BY_NAME if alike else NEVER
        marks = [_agree(p, q) for p, q in seen]
        if min(marks) == 0:
            return NEVER
        telling = any(p not in (0.0, 1.0) for p, _ in seen)  # flags agree by chance
        if alike:
            return RENAME_BY_VALUES if min(marks) == 1 else RENAME_BY_VALUES + 0.1
        return NEVER if not telling else RENAME_BY_VALUES + 0.05 if min(marks) == 1 else NEVER

    return cost


def script(before: list[tuple[str, str]], after: list[tuple[str, str]], tail: list[str], head: list[str], called: dict[str, str] | None = None) -> list[tuple[str, str, str]]:
    """Edit script between the columns (name, type) of two files, given the last and the first records as JSON texts."""
    load = [[r for r in (_record(t) for t in side) if r is not None] for side in (tail, head)]
    pairs = overlap(*load)
    _, steps = edit([Node(*c) for c in before], [Node(*c) for c in after], rename_by_evidence(pairs, called))
    return moves(steps)


def _record(text: str | None) -> dict | None:
    try:
        value = json.loads(text) if text else None
    except ValueError:
        return None
    return value if isinstance(value, dict) else None


def file_columns(footers: DataFrame) -> DataFrame:
    """(batch_id, file_seq, gcs_uri, columns): one row a file, its columns (name, type) in the order of their ordinals."""
    column = F.struct("ordinal", "column_name", "column_type")
    grouped = footers.where("gcs_uri IS NOT NULL AND column_name IS NOT NULL").groupBy("batch_id", "file_seq", "gcs_uri")
    return grouped.agg(F.array_sort(F.collect_set(column)).alias("columns"))


def previous_files(files: DataFrame) -> DataFrame:
    """(gcs_uri, before): each file and the one before it in its batch, in the order of file_seq; a batch's first file is left out.

    Worked out over narrow rows in blocks of SEQ_BLOCK sequence numbers; a block's first file follows the last of the nearest block
    before it, so a batch with any share of all files is spread over its blocks.
    """
    narrow = files.select("batch_id", "file_seq", "gcs_uri").where("file_seq IS NOT NULL").withColumn("b", F.floor(F.col("file_seq") / SEQ_BLOCK))
    inside = Window.partitionBy("batch_id", "b").orderBy("file_seq", "gcs_uri")
    linked = narrow.withColumn("before", F.lag("gcs_uri").over(inside))
    last = narrow.groupBy("batch_id", "b").agg(F.max(F.struct("file_seq", "gcs_uri")).getField("gcs_uri").alias("last"))
    carried = last.select(F.col("batch_id").alias("k"), F.col("b").alias("kb"), F.lag("last").over(Window.partitionBy("batch_id").orderBy("b")).alias("carried"))
    joined = linked.join(carried, F.col("batch_id").eqNullSafe(F.col("k")) & (F.col("b") == F.col("kb")))
    return joined.select("gcs_uri", F.coalesce("before", "carried").alias("before")).where("before IS NOT NULL")


def longest_edge(pairs: DataFrame, rows: DataFrame) -> int:
    """The most records that a file of ``pairs`` (gcs_uri, before) can share with the one before it: those of the shorter of the two."""
    counts = rows.where("gcs_uri IS NOT NULL").groupBy("gcs_uri").agg(F.count(F.lit(1)).alias("n"))
    both = pairs.join(counts, "gcs_uri").join(counts.select(F.col("gcs_uri").alias("before"), F.col("n").alias("m")), "before")
    return both.agg(F.max(F.least("n", "m"))).first()[0] or 0


def edge_records(rows: DataFrame, edge: int) -> DataFrame:
    """(gcs_uri, head, tail): the first and last ``edge`` records of each file, in order. Each map task keeps only its own ``edge`` first
    and last records of a file before anything is shuffled."""
    out = None
    for name, order in (("head", F.col("row_no").asc()), ("tail", F.col("row_no").desc())):
        kept = rows.where("gcs_uri IS NOT NULL").withColumn("n", F.row_number().over(Window.partitionBy("gcs_uri").orderBy(order, F.col("payload")))).where(F.col("n") <= edge)
        side = kept.groupBy("gcs_uri").agg(F.transform(F.array_sort(F.collect_list(F.struct("row_no", "payload"))), lambda x: x["payload"]).alias(name))
        out = side if out is None else out.join(side, "gcs_uri", "full")
    return out


def edit_scripts(footers: DataFrame, rows: DataFrame) -> DataFrame:
    """(gcs_uri, before, kind, old, new): the edit script that leads from each file's predecessor to the file, a row for each step.

    Kinds: kept, added, removed, renamed, retyped, moved; ``old`` and ``new`` are names as written, nested ones with their path. Schemas
    are trees of columns and nested fields; the script is a least-cost one, where a rename is cheap if the records that both files hold
    have the same values under both names (:func:`rename_by_evidence`). What values proved in some files then serves those pairs of files
    that lose one name and gain another for the same quantity without values to compare: they are gone over once more. Each pair of files is one row, so pairs are worked on in
    parallel however they are spread over batches; it holds their records up to the length of the longest possible overlap, so a file must
    fit into a task. Files without records rely on names. Null names are ignored, repeated footer rows
    count once; unreadable records are passed over. Empty inputs give no rows.
    """
    files = file_columns(footers)
    linked = previous_files(files)
    first = materialize(_scripts(files, linked, rows, {}), "p6-scripts")
    called = one_name_each(footers, first, MAX_NAMES)
    if not called:
        return first
    name = lambda c: _called(called)[_plain(c)]
    gone, new = (first.where(F.col("kind") == k).select("gcs_uri", "before", name(F.col(c)).alias("name")).where("name IS NOT NULL") for k, c in (("removed", "old"), ("added", "new")))
    doubtful = materialize(gone.join(new, ["gcs_uri", "before", "name"], "left_semi").select("gcs_uri", "before").distinct(), "p6-doubtful")
    touched = doubtful.select(F.explode(F.array("gcs_uri", "before")).alias("gcs_uri")).distinct()
    again = _scripts(files, doubtful, rows.join(small(touched), "gcs_uri", "left_semi"), called)
    return first.join(small(doubtful.select("gcs_uri")), "gcs_uri", "left_anti").unionByName(again)


def _plain(c: Column) -> Column:
    """Column form of :func:`plain_name`, of the last part of a path."""
    return F.regexp_replace(F.lower(F.trim(F.replace(F.element_at(F.split(c, r"\."), -1), F.lit("\ufeff"), F.lit("")))), "_raw$", "")


def _called(called: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in sorted(called.items()) for x in pair])


def _scripts(files: DataFrame, linked: DataFrame, rows: DataFrame, called: dict[str, str]) -> DataFrame:
    edges = edge_records(rows, longest_edge(linked, rows))
    after = files.select("gcs_uri", F.col("columns").alias("new_columns")).join(edges.select("gcs_uri", "head"), "gcs_uri", "left")
    before = files.select("gcs_uri", F.col("columns").alias("old_columns")).join(edges.select("gcs_uri", "tail"), "gcs_uri", "left")
    pairs = linked.join(after, "gcs_uri").join(before.withColumnRenamed("gcs_uri", "before"), "before")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        listed = lambda x: [] if x is None else list(x)
        columns = lambda x: [(c["column_name"], c["column_type"] or "") for c in listed(x)]
        for batch in batches:
            found = [
                (r.gcs_uri, r.before, *step)
                for r in batch.itertuples(index=False)
                for step in script(columns(r.old_columns), columns(r.new_columns), listed(r.tail), listed(r.head), called)
            ]
            yield pd.DataFrame(found, columns=["gcs_uri", "before", "kind", "old", "new"])

    return pairs.select("gcs_uri", "before", "old_columns", "new_columns", "tail", "head").mapInPandas(work, "gcs_uri STRING, before STRING, kind STRING, old STRING, new STRING")


def one_name_each(footers: DataFrame, scripts: DataFrame, most: int) -> dict[str, str]:
    """The name under which each root comes out: names of one quantity in different batches are brought together by what renames showed.

    Every rename that values proved in some batch says that two plain names stand for one quantity. The proofs, most frequent first, join
    names into groups, but never two names of which some file has both; a group is called by its name of the most columns. At most
    ``most`` names are looked at, as there can be no more columns.
    """
    own = footers.where("gcs_uri IS NOT NULL AND column_name IS NOT NULL").select("gcs_uri", _plain(F.col("column_name")).alias("name")).distinct()
    counted = own.groupBy("name").count().orderBy(F.desc("count"), "name").limit(most + 1).collect()
    if len(counted) > most:
        raise ValueError(f"more than {most} names")
    files = {r["name"]: r["count"] for r in counted}
    proofs = scripts.where("kind IN ('renamed', 'moved')").groupBy(_plain(F.col("old")).alias("a"), _plain(F.col("new")).alias("b")).count()
    listed = proofs.where("a <> b").orderBy(F.desc("count"), "a", "b").limit(most * most).collect()
    names = {x for r in listed for x in (r["a"], r["b"])}
    held = own.where(F.col("name").isin(sorted(names))) if names else own.limit(0)
    beside = held.join(held.withColumnRenamed("name", "other"), "gcs_uri").where("name < other").select("name", "other").distinct().collect()  # a file's names with each other
    apart = {(r["name"], r["other"]) for r in beside}
    group = {x: frozenset([x]) for x in names}
    for r in listed:
        x, y = group[r["a"]], group[r["b"]]
        if x is not y and not any((min(i, j), max(i, j)) in apart for i in x for j in y):
            for i in x | y:
                group[i] = x | y
    return {x: max(g, key=lambda n: (files.get(n, 0), n)) for x, g in group.items()}


def column_roots(footers: DataFrame, scripts: DataFrame) -> DataFrame:
    """(gcs_uri, column_name, root): every column of every file and the quantity it stands for.

    Columns are linked to the one they came from by the scripts; links are doubled until each column knows the first one of its line,
    so a batch of K files takes log2(K) rounds. The root is that first name without marks and case.
    """
    own = footers.where("gcs_uri IS NOT NULL AND column_name IS NOT NULL").select("gcs_uri", "column_name").distinct()
    came = scripts.where("kind IN ('kept', 'renamed', 'moved')").select(F.col("gcs_uri").alias("u"), F.col("new").alias("c"), F.col("before").alias("pu"), F.col("old").alias("pc"))
    links = materialize(
        own.join(came, (F.col("gcs_uri") == F.col("u")) & (F.col("column_name") == F.col("c")), "left").select("gcs_uri", "column_name", "pu", "pc"), "roots"
    )
    while True:
        up = links.select(F.col("gcs_uri").alias("xu"), F.col("column_name").alias("xc"), F.col("pu").alias("nu"), F.col("pc").alias("nc"))
        stepped = links.join(up, (F.col("pu") == F.col("xu")) & (F.col("pc") == F.col("xc")), "left")
        further = F.col("nu").isNotNull()
        links = materialize(
            stepped.select("gcs_uri", "column_name", F.when(further, F.col("nu")).otherwise(F.col("pu")).alias("pu"), F.when(further, F.col("nc")).otherwise(F.col("pc")).alias("pc"), further.alias("moved")),
            "roots",
        )
        if links.where("moved").isEmpty():
            break
        links = links.drop("moved")
    first = F.coalesce("pc", "column_name")
    return links.select("gcs_uri", "column_name", _plain(first).alias("root"))


def unify(footers: DataFrame, rows: DataFrame, scripts: DataFrame, max_columns: int = MAX_NAMES) -> DataFrame:
    """All records in one table: gcs_uri, row_no and a column for each quantity, in alphabetical order.

    A quantity is a line of columns that the scripts link; lines of different batches come together by :func:`one_name_each`. The scripts,
    compiled to a map from each file's own names to quantities, are applied to a file's records as one projection. Quantities
    that were always numbers in the footers become DOUBLE (thousands separators removed, blanks and dashes null), all others are STRING. A
    quantity called gcs_uri or row_no gets the suffix ``_in``.
    More than ``max_columns`` quantities raise ValueError, as the schema has to be known to the driver. Records that two files share
    appear for both.
    """
    roots = materialize(column_roots(footers, scripts), "map")
    called = one_name_each(footers, scripts, max_columns)
    if called:
        roots = roots.withColumn("root", F.coalesce(_called(called)[F.col("root")], F.col("root")))
    kinds = footers.select("gcs_uri", "column_name", F.lower("column_type").rlike(r"^(double|float|decimal|int|bigint|boolean)").alias("number")).distinct()
    schema = roots.join(kinds, ["gcs_uri", "column_name"]).groupBy("root").agg(F.bool_and("number").alias("number")).orderBy("root").limit(max_columns + 1).collect()
    if len(schema) > max_columns:
        raise ValueError(f"more than {max_columns} quantities")
    maps = roots.groupBy("gcs_uri").agg(F.map_from_entries(F.collect_set(F.struct("column_name", "root"))).alias("names"))
    read = rows.join(maps, "gcs_uri", "left").withColumn("own", F.from_json("payload", "map<string,string>"))
    # two names of one file that stand for the same quantity: the first in the record that has a value
    entries = F.transform(F.map_entries("own"), lambda e: F.struct(F.col("names")[e["key"]].alias("root"), e["value"].alias("value")))
    out = read.select("gcs_uri", "row_no", entries.alias("entries"))

    def pick(root: str, number: bool):
        value = F.try_element_at(F.filter("entries", lambda e: (e["root"] == root) & e["value"].isNotNull()), F.lit(1))["value"]
        text = F.trim(value)
        if not number:
            return F.nullif(text, F.lit(""))
        truth = F.when(F.lower(text) == "true", 1.0).when(F.lower(text) == "false", 0.0)
        return F.coalesce(truth, F.replace(text, F.lit(","), F.lit("")).try_cast("double"))

    names = renamed([r["root"] for r in schema], ["gcs_uri", "row_no"])
    return out.select("gcs_uri", "row_no", *[pick(r["root"], r["number"]).alias(names.get(r["root"], r["root"])) for r in schema])
