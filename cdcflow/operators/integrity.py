"""Constraints as operators that return the violations.

Files enforce no keys, lengths or document schemas, so each declared constraint
of a ``TableSpec`` becomes a query for the rows that break it.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.functions.canonical import computed_once
from cdcflow.functions.joins import splittable
from cdcflow.session import new_dir
from cdcflow.sources.files import land_parquet
from cdcflow.specs import CASCADE, NOW, SET_NULL, DocumentRule, TableSpec, load_order


def missing_tables(
    spark: SparkSession, required: Sequence[str], present: DataFrame | None = None
) -> DataFrame:
    """Required names that are absent, compared without case.

    ``present`` is a column of names; by default the session catalog is asked.
    """
    names = [(name.lower(),) for name in required]
    wanted = spark.createDataFrame(names, "table_name string")
    if present is None:
        listed = [(t.name,) for t in spark.catalog.listTables()]
        present = spark.createDataFrame(listed, "table_name string")
    known = present.select(F.lower(F.col(present.columns[0])).alias("known")).distinct()
    return wanted.join(known, F.col("table_name") == F.col("known"), "left_anti")


def probe_row(df: DataFrame, key: str, value) -> DataFrame:
    """Whether a row with this key exists."""
    found = df.filter(F.col(key) == value).limit(1)
    return found.agg((F.count("*") > 0).alias("found"))


def null_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Required columns holding NULL: key of the row and column name."""
    required = [c.name for c in spec.columns if c.required and c.name in df.columns]
    nulls = F.array_compact(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]).cast("array<string>")
    )
    return df.select(F.col(spec.key), F.explode(nulls).alias("column_name"))


def unique_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values on several rows, with their number; NULLs never collide."""
    keyed = df.select(*columns).dropna(how="any")
    counted = keyed.groupBy(*columns).agg(F.count("*").alias("row_count"))
    return counted.filter(F.col("row_count") > 1)


def constraint_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """All declared constraints of a table: ``column_name, rule, value, row_count``.

    ``rule`` is ``required`` or ``length`` (with the row's key as ``value``, counted by
    row) or ``unique`` (with the value that several rows share, and their number).
    """
    key = F.col(spec.key).cast("string").alias("value")
    one = F.lit(1).cast("bigint").alias("row_count")
    nulls = null_violations(df, spec).select(
        "column_name", F.lit("required").alias("rule"), key, one
    )
    lengths = length_violations(df, spec).select(
        "column_name", F.lit("length").alias("rule"), key, one
    )
    found = nulls.unionByName(lengths)
    for column in (c.name for c in spec.columns if c.unique and c.name in df.columns):
        found = found.unionByName(
            unique_violations(df, [column]).select(
                F.lit(column).alias("column_name"),
                F.lit("unique").alias("rule"),
                F.col(column).cast("string").alias("value"),
                "row_count",
            )
        )
    return found


def length_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Values longer than declared: key of the row, column name, length found."""
    limited = [c for c in spec.columns if c.length and c.name in df.columns]
    if not limited:
        nothing = df.select(
            F.col(spec.key),
            F.lit("").alias("column_name"),
            F.lit(0).alias("found_length"),
        )
        return nothing.filter("false")
    found = F.array_compact(
        F.array(
            *[
                F.when(
                    F.char_length(c.name) > c.length,
                    F.struct(
                        F.lit(c.name).alias("column_name"),
                        F.char_length(c.name).alias("found_length"),
                    ),
                )
                for c in limited
            ]
        )
    )
    return df.select(F.col(spec.key), F.inline(found))


def fill_defaults(df: DataFrame, spec: TableSpec, now) -> DataFrame:
    """The table's columns, absent ones at their declared default.

    A default applies to a column an insert leaves out; a NULL that is present
    stays.
    """
    now = now if not isinstance(now, str) else F.lit(now)

    def value(column):
        if column.name in df.columns:
            return F.col(column.name)
        return now if column.default is NOW else F.lit(column.default)

    return df.select(*[value(c).cast(c.type).alias(c.name) for c in spec.columns])


# --- foreign keys ------------------------------------------------------------


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose key names no parent; a NULL key names none and is fine."""
    parents = _parents(parent.select(pk))
    keyed = child.filter(F.col(fk).isNotNull())
    return keyed.join(parents, F.col(fk) == F.col("_parent"), "left_anti")


def cascade_delete(child: DataFrame, fk: str, deleted_keys: DataFrame) -> DataFrame:
    """Child rows that stay when these parents go."""
    gone = _parents(deleted_keys)
    return child.join(gone, F.col(fk) == F.col("_parent"), "left_anti")


def cascade_removed(child: DataFrame, fk: str, deleted_keys: DataFrame) -> DataFrame:
    """Child rows that go with these parents, to be logged as deletes."""
    gone = _parents(deleted_keys)
    return child.join(gone, F.col(fk) == F.col("_parent"), "left_semi")


def cascade_set_null(child: DataFrame, fk: str, deleted_keys: DataFrame) -> DataFrame:
    """Child rows with the key emptied where its parent goes."""
    # distinct, so that no child row doubles
    gone = splittable(_parents(deleted_keys).distinct(), "_parent")
    kept = F.when(F.col("_parent").isNull(), F.col(fk)).alias(fk)
    return child.join(gone, F.col(fk) == F.col("_parent"), "left").select(
        *[kept if c == fk else F.col(c) for c in child.columns]
    )


def _parents(deleted_keys: DataFrame) -> DataFrame:
    keys = deleted_keys.select(F.col(deleted_keys.columns[0]).alias("_parent"))
    return splittable(keys, "_parent")


def cascade(
    tables: dict[str, DataFrame],
    specs: Iterable[TableSpec],
    deleted: dict[str, DataFrame],
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Carry deletes through the foreign-key graph, parents first.

    ``deleted`` maps table names to deleted keys. Returns every table after the
    deletes, and the keys that went from each, cascaded ones included. A table that
    refers to itself is refused: its chains have no fixed depth.
    """
    specs = list(specs)
    for spec in specs:
        if any(fk.parent == spec.name for fk in spec.foreign_keys):
            raise ValueError(f"{spec.name} refers to itself: cascade_closure carries its deletes on")
    gone = {name: _landed(_parents(keys).distinct()) for name, keys in deleted.items()}
    for spec in load_order(specs):
        hit = _hit(tables[spec.name], spec, gone)
        if hit is not None:
            own = [gone[spec.name]] if spec.name in gone else []
            gone[spec.name] = _landed(functools.reduce(DataFrame.union, own, hit).distinct())
    return _remaining(tables, specs, gone), _keys(gone)


def cascade_closure(
    tables: dict[str, DataFrame],
    specs: Iterable[TableSpec],
    deleted: dict[str, DataFrame],
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """As ``cascade``, for foreign keys that refer to their own table or form a circle.

    Table by table, in turns: the keys of its parents that went since its last turn take its
    rows along, whatever is gone already left out, until no table has such parents. A turn
    scans the landed key columns of one table once and writes the new keys as a folder
    of its own, so a plan does not grow with the turns. There are at most as many turns of a
    table as the longest chain of rows has links.
    """
    specs = list(specs)
    linked = [s for s in specs if any(fk.on_delete == CASCADE for fk in s.foreign_keys)]
    links: dict[str, DataFrame] = {}
    key_columns = {s.name: tables[s.name].select(s.key) for s in specs}
    went = {name: _Went(keys, key_columns.get(name, keys)) for name, keys in deleted.items()}
    for name, keys in deleted.items():
        went[name].add(_parents(keys).distinct(), empty=True)
    met = {s.name: {fk.parent: 0 for fk in s.foreign_keys if fk.on_delete == CASCADE} for s in linked}
    moved = True
    while moved:
        moved = False
        for spec in linked:
            seen = met[spec.name]
            newest = {p: went[p].since(seen[p]) for p in seen if p in went and len(went[p].folders) > seen[p]}
            if not newest:
                continue
            seen.update({p: len(went[p].folders) for p in newest})
            if spec.name not in links:
                links[spec.name] = _links(tables[spec.name], spec)
            hit = _hit(links[spec.name], spec, newest)
            own = went.get(spec.name)
            if own is None:
                own = _Went(hit, hit)
            else:
                known = own.since(0).withColumnRenamed("_parent", "_known")
                hit = hit.join(known, F.col("_parent").eqNullSafe(F.col("_known")), "left_anti")
            if own.add(hit.distinct()):
                went[spec.name] = own
                moved = True
    gone = {name: own.since(0) for name, own in went.items()}
    return _remaining(tables, specs, gone), _keys(gone)


class _Went:
    """Keys of one table that went, in a folder for each time some were found."""

    def __init__(self, keys: DataFrame, others: DataFrame):
        self.spark, self.root = keys.sparkSession, new_dir(keys.sparkSession, "gone")
        both = keys.select(F.col(keys.columns[0])).union(others.select(F.col(others.columns[0])))
        self.kind = both.schema[0].dataType
        self.folders: list[str] = []

    def add(self, keys: DataFrame, empty: bool = False) -> bool:
        """Write the keys; whether there are any, or ``empty`` lets none count as some."""
        folder = f"{self.root}/found={len(self.folders)}"
        found = land_parquet(keys.select(F.col("_parent").cast(self.kind).alias("_parent")), folder)
        if not empty and found.isEmpty():
            return False
        self.folders.append(folder)
        return True

    def since(self, n: int) -> DataFrame:
        """The keys of all folders but the first ``n``."""
        schema = T.StructType([T.StructField("_parent", self.kind)])
        return self.spark.read.schema(schema).parquet(*self.folders[n:])


def _links(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys of the rows that may go with a parent, with those of their parents, landed."""
    columns = [fk.column for fk in spec.foreign_keys if fk.on_delete == CASCADE]
    narrow = rows.select(*dict.fromkeys([spec.key, *columns]))
    return _landed(narrow.dropna(how="all", subset=columns))


def _landed(keys: DataFrame) -> DataFrame:
    """Keys in a table of their own: the plans that use them do not derive them again."""
    return land_parquet(keys, new_dir(keys.sparkSession, "gone"))


def _keys(gone: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: keys.select(F.col("_parent").alias("key")) for name, keys in gone.items()}


def _flagged(rows: DataFrame, columns: Sequence[str], gone: Sequence[DataFrame]) -> DataFrame:
    """Rows with a flag per column: whether its value is among these keys."""
    for i, (column, keys) in enumerate(zip(columns, gone)):
        flagged = splittable(keys.select("_parent", F.lit(True).alias(f"_gone{i}")), "_parent")
        flagged = flagged.withColumnRenamed("_parent", f"_parent{i}")
        rows = rows.join(flagged, F.col(column) == F.col(f"_parent{i}"), "left").drop(f"_parent{i}")
    return rows


def _hit(rows: DataFrame, spec: TableSpec, gone: dict[str, DataFrame]) -> DataFrame | None:
    """Keys of the rows that go with parents among ``gone``, from one scan; None without such."""
    fks = [fk for fk in spec.foreign_keys if fk.on_delete == CASCADE and fk.parent in gone]
    if not fks:
        return None
    narrow = rows.select(*dict.fromkeys([spec.key, *(fk.column for fk in fks)]))
    flagged = _flagged(narrow, [fk.column for fk in fks], [gone[fk.parent] for fk in fks])
    taken = F.coalesce(*[F.col(f"_gone{i}") for i in range(len(fks))])
    return flagged.filter(taken).select(F.col(spec.key).alias("_parent"))


def _remaining(tables, specs: list[TableSpec], gone: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every table without the rows that are gone and with emptied keys: a row that goes by
    a foreign key goes by that, without its own key, which may be NULL, being looked up."""
    remaining = {}
    for spec in specs:
        rows = tables[spec.name]
        fks = [fk for fk in spec.foreign_keys if fk.parent in gone]
        columns, keys = [fk.column for fk in fks], [gone[fk.parent] for fk in fks]
        if spec.name in gone:
            columns, keys = [*columns, spec.key], [*keys, gone[spec.name]]
        flagged = _flagged(rows, columns, keys)
        emptied = {}
        for i, fk in enumerate([*fks, None][: len(columns)]):
            flag = F.coalesce(F.col(f"_gone{i}"), F.lit(False))
            if fk is None or fk.on_delete == CASCADE:
                flagged = flagged.filter(~flag)
            elif fk.on_delete == SET_NULL:
                emptied[fk.column] = F.when(~flag, F.col(fk.column)).alias(fk.column)
        remaining[spec.name] = flagged.select(*[emptied.get(c, F.col(c)) for c in rows.columns])
    return remaining


# --- document schemas --------------------------------------------------------


def schema_violations(
    docs: DataFrame, rules: Sequence[DocumentRule], json: str = "json"
) -> DataFrame:
    """Document fields that are required but missing, or of a type not allowed.

    ``json`` names the column of document texts. A missing field and an explicit
    null differ: only the former breaks ``required``. Text that is no JSON object
    breaks the rule on ``$``.
    """
    text = F.ltrim(F.col(json), F.lit(" \t\r\n"))
    parsed = computed_once(docs.select(json), "_doc", F.try_parse_json(json)).select(
        F.try_variant_get("_doc", "$._id", "string").alias("_id"),
        (F.col("_doc").isNotNull() & text.startswith("{")).alias("_readable"),
        F.when(F.col("_doc").isNull(), "unparsable")
        .when(~text.startswith("{"), json_type(F.schema_of_variant("_doc")))
        .alias("_root"),
        "_doc",
    )
    # one row per rule: what is found is looked up once and then only compared
    looked_up = F.inline(F.array(*[_lookup(i, r) for i, r in enumerate(rules)]))
    found = parsed.select("_id", "_readable", "_root", looked_up)
    kind = F.col("_kind")
    plain = F.substring_index(F.substring_index(kind, "<", 1), "(", 1)
    missing = F.col("_required") & kind.isNull()
    wrong = ~F.array_contains("_allowed", plain)
    broken = F.when(F.col("_readable"), missing | wrong).otherwise(F.col("_number") == 0)
    return found.filter(broken).select(
        "_id",
        F.when(F.col("_readable"), F.col("path")).otherwise("$").alias("path"),
        F.when(~F.col("_readable"), F.col("_root"))
        .when(kind.isNull(), "missing")
        .otherwise(json_type(kind))
        .alias("found_type"),
        F.when(F.col("_readable") & kind.isNull(), "required")
        .otherwise("type")
        .alias("rule"),
    )


# JSON type names and the names variant schemas give them.
_KINDS = {
    "null": ("VOID",),
    "int": ("BIGINT",),
    "string": ("STRING",),
    "bool": ("BOOLEAN",),
    "object": ("OBJECT",),
    "array": ("ARRAY",),
    "double": ("DOUBLE", "DECIMAL", "FLOAT"),
}


def _lookup(number: int, rule: DocumentRule):
    value = F.try_variant_get("_doc", f"$.{rule.path}", "variant")
    allowed = [F.lit(kind) for t in rule.types for kind in _KINDS[t]]
    return F.struct(
        F.lit(number).alias("_number"),
        F.lit(rule.path).alias("path"),
        F.schema_of_variant(value).alias("_kind"),
        F.array(*allowed).alias("_allowed"),
        F.lit(rule.required).alias("_required"),
    )


def json_type(kind):
    """JSON type name of a variant's schema; NULL for no value at all."""
    names = F.lit(None)
    for name, kinds in _KINDS.items():
        for known in kinds:
            names = F.when(kind.startswith(known), name).otherwise(names)
    return names
