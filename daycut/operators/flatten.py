"""Schema-directed flatten of JSON lines (P1/P2), projection on a declared
schema (P3), type coercion (P4), the productivity rule (P5) and reject
handling (K5) — one Catalyst ``select`` per line, no UDF.

A nested key path such as ``value[0].fpVal`` becomes the column name
``value0_fpVal`` (``.`` → ``_``, brackets removed; with ``drop_parens`` also
``(`` and ``)``: ``time_spent_(seconds)`` → ``time_spent_seconds``).  Only
names of the target schema are kept (case-sensitive), absent ones are NULL,
and when several paths normalise to the same name the last one wins.

Two parse modes:

* ``input_schema`` given (nested lines): ``from_json`` once with the declared
  line schema (all leaves read as text); the leaf → name mapping is computed on
  the driver from the schema, so the select is static;
* no ``input_schema`` (flat lines): ``from_json`` to ``map<string,string>``;
  each target name takes the last entry whose normalised key equals it.  This
  mode accepts any key spelling, but its per-key lambdas are interpreted
  (about 5× the cost of the declared mode).

Key presence (a JSON ``null`` is not an absent key) is available in both
modes: with ``input_schema`` the ``presence`` fields are parsed as VARIANT,
which is SQL NULL only when the key is absent.  In the declared mode, when
two declared keys normalise to the same name, the later one in the schema
that is set in the line wins.

A target column that no declared key yields (with ``input_schema``), or whose
name can be a nested path (without), is looked up at every path of the lines
that normalises to its name, keys holding ``.`` or brackets included.  One
aggregation over the lines finds these paths (``path_dictionary``; or pass
``paths``), and a second, VARIANT parse of the line reads them; only such a
target pays for both.  Where a line has several of these paths, the one with the
fewest nested parts wins.

A line that is not a JSON object, or whose present value does not convert to
the target type, is a reject: rows come back with ``_reject_reason`` set and
``split_rejects`` separates them.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycut.functions import labels
from daycut.operators.rows import computed
from daycut.session import checkpointed
from daycut.sources.schema import SchemaError

CORRUPT = "_corrupt_record"
REASON = "_reject_reason"
LINE = "_line"

BRACKETS = "[]"
BRACKETS_AND_PARENS = "[]()"


def normalise(path_name: str, drop_chars: str = BRACKETS) -> str:
    """``a.b[0].c`` → ``a_b0_c`` (the column-name rule)."""
    out = path_name.replace(".", "_")
    return re.sub("[" + re.escape(drop_chars) + "]", "", out) if drop_chars else out


Path = tuple[str | int, ...]        # keys and array positions, outermost first

_CHARS = r'(?:[^"\\\x00-\x1f]++|\\["\\/bfnrt]|\\u[0-9a-fA-F]{4})*+'
_KEY_OR_TEXT = f'("{_CHARS}"\\s*+:)|("){_CHARS}(")'
_QUOTED_OR_PLAIN = (f'("{_CHARS}")|(?<![-+.\\w])(?:-?+(?:0|[1-9][0-9]*+)(?:\\.[0-9]++)?+(?:[eE][-+]?+[0-9]++)?+|true|false|null)'
                    r'(?![-+.\w])')
_MARK = "\x01"                      # no character of a JSON text


def shape(line: Column) -> Column:
    """A JSON line with every text value emptied and every other plain value
    0: keys, nesting and positions alone.  What is no JSON stays no JSON."""
    bare = F.regexp_replace(line, _KEY_OR_TEXT, "$1$2$3")
    bare = F.replace(F.regexp_replace(bare, _QUOTED_OR_PLAIN, f"$1{_MARK}"), F.lit(f'"{_MARK}'), F.lit('"'))
    return F.when(line.contains(_MARK), line).otherwise(F.translate(bare, _MARK, "0"))


def path_dictionary(lines: DataFrame, wanted: set[str], drop_chars: str = BRACKETS,
                    text_col: str = "value") -> dict[str, list[Path]]:
    """Of each wanted column name, the paths of the lines that spell it.

    Lines of one shape have the same paths, so only the distinct shapes are
    parsed: level by level every key and array position is appended to its path
    and name, what no wanted name starts with is dropped, and the distinct
    (name, path) pairs remain, few whatever the number of lines.  Fewest parts
    first.  Dictionaries of several files merge with :func:`merge_dictionaries`.
    """
    if not wanted:
        return {}
    if lines.isStreaming:
        raise SchemaError("a stream needs paths= for columns of undeclared keys: " + ", ".join(sorted(wanted)))
    names = F.array(*[F.lit(n) for n in sorted(wanted)])
    step = "struct<key:string,pos:int>"
    # no filter of the levels below may run on the lines themselves
    shapes = checkpointed(lines.select(shape(F.col(text_col)).alias("shape")).distinct())
    rows = shapes.select(F.lit("").alias("name"), F.array().cast(f"array<{step}>").alias("path"),
                         F.try_parse_json("shape").alias("v")).where("v IS NOT NULL")

    def part(key: Column, pos: Column) -> Column:
        return F.concat("path", F.array(F.struct(key.cast("string").alias("key"), pos.cast("int").alias("pos")).cast(step)))

    def spelled(kid: Column) -> Column:
        return F.exists(names, lambda n: n.startswith(kid["name"]))

    kid = "array<struct<name:string,path:array<struct<key:string,pos:int>>,v:variant>>"
    # a path is at most as deep as its name has parts: keys after "_", positions as digits
    depth = max(1 + sum(c == "_" or c.isdigit() for c in n) for n in wanted)
    for level in range(depth):
        keys = F.map_entries(F.try_variant_get("v", "$", "map<string,variant>"))
        cells = F.try_variant_get("v", "$", "array<variant>")
        gap = F.lit("_" if level else "")
        of_object = F.transform(keys, lambda e: F.struct(F.concat("name", gap, _norm_key(e["key"], drop_chars)).alias("name"),
                                                         part(e["key"], F.lit(None)).alias("path"), e["value"].alias("v")))
        of_array = F.transform(cells, lambda x, i: F.struct(F.concat("name", i.cast("string")).alias("name"),
                                                            part(F.lit(None), i).alias("path"), x.alias("v")))
        leaf = F.when(F.array_contains(names, F.col("name")), F.array(F.struct("name", "path", "v"))).otherwise(
            F.array().cast(kid))
        rows = rows.select(F.inline(F.coalesce(F.filter(of_object, spelled), F.filter(of_array, spelled), leaf)))
    nested = F.coalesce(F.try_variant_get("v", "$", "map<string,variant>").isNotNull(), F.lit(False)) \
        | F.try_variant_get("v", "$", "array<variant>").isNotNull()
    found: dict[str, list[Path]] = {}
    for r in rows.where(~nested).where(F.array_contains(names, F.col("name"))).select("name", "path").distinct().collect():
        found.setdefault(r.name, []).append(tuple(p.key if p.pos is None else p.pos for p in r.path))
    return merge_dictionaries(found)


def merge_dictionaries(*parts: dict[str, list[Path]]) -> dict[str, list[Path]]:
    """The paths of all parts, each once, fewest parts first."""
    names = sorted({n for p in parts for n in p})
    return {n: sorted({x for p in parts for x in p.get(n, [])}, key=lambda x: (len(x), [str(k) for k in x])) for n in names}


def _at(variant: Column, path: Path, as_type: str = "variant") -> Column:
    """The VARIANT (or ``as_type``) at a path.  A key that the path syntax
    cannot quote is looked up in the object's map."""
    text = "$"
    for key in path:
        if isinstance(key, int):
            text += f"[{key}]"
        elif key and "'" not in key:
            text += f"['{key}']"
        elif key and '"' not in key:
            text += f'["{key}"]'
        else:
            variant = F.try_element_at(F.try_variant_get(variant, text, "map<string,variant>"), F.lit(key))
            text = "$"
    return F.try_variant_get(variant, text, as_type)


def _found(rows: DataFrame, variant: Column, lookup: dict[str, list[Path]]) -> tuple[DataFrame, dict[str, Column]]:
    """Of each name, text of the first of its paths that holds a plain value.
    The texts are columns of their own, made once a row."""
    paths = sorted({p for ps in lookup.values() for p in ps}, key=str)
    of = {p: f"__at{i}" for i, p in enumerate(paths)}
    rows = rows.select("*", *[_at(variant, p, "string").alias(c) for p, c in of.items()])

    def plain(p: Path) -> Column:
        text = F.col(of[p])
        # an object or array gives text too; a plain text may begin like one
        nested = F.substring(text, 1, 1).isin("{", "[") & F.schema_of_variant(_at(variant, p)).rlike("^(OBJECT|ARRAY)")
        return F.when(~nested, text)

    rows = rows.select("*", *[F.coalesce(*map(plain, ps)).alias(f"__name{i}") for i, ps in enumerate(lookup.values())])
    return rows, {n: F.col(f"__name{i}") for i, n in enumerate(lookup)}


def _as_text(dt: T.DataType) -> T.DataType:
    """The same shape with every leaf read as text."""
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType), True)
                             for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(_as_text(dt.elementType), True)
    return T.StringType()


def _leaves(dt: T.DataType, col: Column, path: str, wanted: set[str], drop_chars: str,
            out: list):
    """Collect (normalised name, column) for leaves whose name is wanted."""
    if isinstance(dt, T.StructType):
        for f in dt.fields:
            sub = f"{path}.{f.name}" if path else f.name
            _leaves(f.dataType, col[f.name] if path else F.col(f"__j.`{f.name}`"),
                    sub, wanted, drop_chars, out)
    elif isinstance(dt, T.ArrayType):
        # which positions can produce a wanted name: match "<prefix>N<rest>"
        prefix = re.escape(normalise(path, drop_chars))
        idx = set()
        for w in wanted:
            m = re.match(prefix + r"(\d+)", w)
            if m:
                idx.add(int(m.group(1)))
        for i in sorted(idx):
            _leaves(dt.elementType, F.get(col, F.lit(i)), f"{path}[{i}]", wanted,
                    drop_chars, out)
    else:
        name = normalise(path, drop_chars)
        if name in wanted:
            out.append((name, col))


def _typed(raw: Column, dt: T.DataType) -> Column:
    # try_cast follows ANSI rules: "1.5", "1e3", "0x10" or an overflow give
    # NULL for integer types (no silent truncation); blanks around digits
    # and a sign are accepted
    return raw if isinstance(dt, T.StringType) else raw.try_cast(dt)


def _norm_key(k: Column, drop_chars: str) -> Column:
    # one pass: '.' becomes '_', every character of drop_chars is deleted
    return F.translate(k, "." + drop_chars, "_")


def _normalised_entries(m: Column, drop_chars: str) -> Column:
    """map → array<struct<k, v>> with normalised keys, in the map's order."""
    return F.transform(F.map_entries(m), lambda e: F.struct(
        _norm_key(e["key"], drop_chars).alias("k"), e["value"].alias("v")))


def _entries_named(name: str):
    def pred(e):
        return e["k"] == F.lit(name)
    return pred


def flatten_project(lines: DataFrame, target: T.StructType, *,
                    input_schema: T.StructType | None = None,
                    drop_chars: str = BRACKETS, text_col: str = "value",
                    keep: list[str] | None = None,
                    presence: list[str] | None = None,
                    paths: dict[str, list[Path]] | None = None) -> DataFrame:
    """JSON text lines → rows of ``target`` plus ``_reject_reason``/``_line``.

    Columns of undeclared keys are found by ``paths``; without it one pass over
    the lines finds them (:func:`path_dictionary`).

    ``keep`` passes extra input columns through (e.g. a path-derived user id);
    ``presence`` (flat mode) adds ``_has_<name>`` flags for key presence.
    """
    keep = keep or []
    wanted = {f.name for f in target.fields}
    line = F.col(text_col)
    raw: dict[str, Column] = {}
    if input_schema is not None:
        presence_set = set(presence or [])
        parse = T.StructType(
            [T.StructField(f.name, T.VariantType() if f.name in presence_set
                           else _as_text(f.dataType), True) for f in input_schema.fields]
            + [T.StructField(CORRUPT, T.StringType(), True)])
        base = lines.select(*keep, line.alias(LINE),
                            F.from_json(line, parse).alias("__j"))
        leaves: list = []
        present = {}
        for f in input_schema.fields:     # in schema order: later leaves win
            if f.name in presence_set:
                v = F.col(f"__j.`{f.name}`")
                leaves.append((normalise(f.name, drop_chars),
                               F.try_variant_get(v, "$", "string")))
                present[normalise(f.name, drop_chars)] = v.isNotNull()
            else:
                _leaves(T.StructType([f]), None, "", wanted, drop_chars, leaves)
        for name, col in leaves:
            # several declared keys with one name: the last one that is set wins
            raw[name] = F.coalesce(col, raw[name]) if name in raw else col
        bad_line = F.col("__j").isNull() | F.col(f"__j.{CORRUPT}").isNotNull()
        asked = wanted - set(raw)
        found_at = path_dictionary(lines, asked, drop_chars, text_col) if paths is None else paths
        lookup = {n: found_at[n] for n in sorted(asked) if found_at.get(n)}
    else:
        parsed = F.from_json(line, "map<string,string>")
        base = lines.select(*keep, line.alias(LINE), parsed.isNull().alias("__bad"),
                            _normalised_entries(parsed, drop_chars).alias("__e"))
        entries = F.col("__e")
        present = {}
        for name in sorted(wanted | set(presence or [])):
            hits = F.filter(entries, _entries_named(name))
            if name in wanted:
                raw[name] = F.try_element_at(hits, F.lit(-1))["v"]
            present[name] = F.size(hits) > 0
        bad_line = F.col("__bad")
        # only a name with "_" or a digit can be a nested path
        asked = {n for n in wanted if re.search(r"_|\d", n)}
        found_at = path_dictionary(lines, asked, drop_chars, text_col) if paths is None else paths
        lookup = {n: deep for n in sorted(asked) if (deep := [p for p in found_at.get(n, []) if len(p) > 1])}
    whole = F.col("__v")
    if lookup:
        base, texts = _found(base.withColumn("__v", F.try_parse_json(F.col(LINE))), whole, lookup)
    for name in lookup:
        found = texts[name]
        raw[name] = F.coalesce(raw[name], found) if name in raw else found
    cols, checks = [], []
    for f in target.fields:
        r = raw.get(f.name)
        if r is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        typed = _typed(r, f.dataType)
        cols.append(typed.alias(f.name))
        checks.append(F.when(r.isNotNull() & typed.isNull(),
                             F.lit(f"bad {f.dataType.simpleString()}: {f.name}")))
    reason = F.when(bad_line, F.lit("not a JSON object"))
    if lookup and input_schema is not None:
        # such as a key twice in one object
        reason = F.coalesce(reason, F.when(whole.isNull(), F.lit("not readable for undeclared columns")))
    if checks:
        reason = F.coalesce(reason, *checks)
    extra = [v.alias(f"_has_{k}") for k, v in present.items() if k in (presence or [])]
    return computed(base, [*[F.col(k) for k in keep], *cols, *extra, reason.alias(REASON),
                           F.col(LINE)])


def apply_productivity(rows: DataFrame, has_col: str = "_has_productivity",
                       raw_col: str = "productivity") -> DataFrame:
    """P5: a present productivity code must be an integer in -2..2, and sets
    ``productivity_string``; a present-but-null or bad code rejects the row;
    an absent key leaves both as they are."""
    code = F.col(raw_col)
    has = F.col(has_col) if has_col in rows.columns else code.isNotNull()
    bad = has & ~labels.productivity_code_valid(code)
    reason = F.coalesce(F.col(REASON), F.when(bad, F.lit("bad productivity code")))
    label = F.when(has, labels.productivity_label(code)).otherwise(F.col("productivity_string")) \
        if "productivity_string" in rows.columns else labels.productivity_label(code)
    # cheap expressions over already computed columns: a plain projection
    out = [label.alias("productivity_string") if c == "productivity_string"
           else reason.alias(REASON) if c == REASON else F.col(c) for c in rows.columns]
    return rows.select(*out)


def split_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the bookkeeping columns, rejects with reason, line
    and, where the rows have one, the lake's ``day``)."""
    good = rows.filter(F.col(REASON).isNull())
    data_cols = [c for c in rows.columns if c not in (REASON, LINE) and not c.startswith("_has_")]
    rejects = rows.filter(F.col(REASON).isNotNull()).select(F.col(REASON).alias("reason"),
                                                            F.col(LINE).alias("line"),
                                                            *[c for c in data_cols if c == "day"])
    return good.select(*data_cols), rejects
