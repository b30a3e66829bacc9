"""Secret scan with multipart credential linking, in DataFrame functions alone.

Base findings are reported always.  Weak candidates (account names, bare
random strings, endpoints) prove nothing alone: an interval join links the
parts of a credential inside a scope, and a weak candidate is reported only if
its complementary parts lie within that scope.

Spans come from two built-in functions: ``split`` gives the text between the
matches of a pattern and ``regexp_extract_all`` the matches, so the running sum
of their lengths gives every start, in code points.  Running sums are taken by
doubled distances and spans are looked up by bisection, so a text of n findings
costs about n log n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycut.session import checkpointed

from .common import free_names, keyed

#: Kinds in the order in which they sort, patterns and roles.
#: The first three are the base kinds.
KINDS = ("assign", "access", "hex", "account", "bare", "endpoint")
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ACCOUNT = r"""(?i:user_?name|user|login|client_?id|account|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@+-]{3,}"""
BARE = r"[A-Za-z0-9+/_-]{20,}"
ENDPOINT = r"(?:https?|ftp|ssh|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9._:/@-]{4,}"
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", "account": "identifier", "bare": "secret",
        "endpoint": "endpoint"}
#: What must lie in scope for a weak candidate to be reported.
NEEDS = {"account": ("secret",), "bare": ("identifier",), "endpoint": ("identifier", "secret")}
#: Parts of one credential lie at most so many code points apart.
SCOPE = 256

_SPANS = "array<struct<start:int,kind:int,stop:int>>"
#: Texts are cut for redaction in pieces of 2 to this power of code points.
_PIECE = 10


def _powers(falling: bool = False) -> Column:
    """Powers of two that an array index can hold."""
    return F.array(*[F.lit(1 << k) for k in sorted(range(31), reverse=falling)])


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for all lambdas inside it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, join) -> Column:
    """Running totals of an array under ``join``, by doubled distances: a pass
    for each power of two below the array's size."""
    return F.aggregate(F.filter(_powers(), lambda d: d < F.size(values)), values, lambda acc, d: F.transform(
        acc, lambda x, i: F.when(i >= d, join(x, F.get(acc, i - d))).otherwise(x)))


def _spans(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """Spans of all matches (leftmost, not overlapping) that ``keep``."""

    def located(hits: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
        ends = _let(F.zip_with(gaps, hits, lambda gap, hit: F.length(gap) + F.length(hit)),
                    lambda steps: _running(steps, lambda x, y: x + y))
        spans = F.zip_with(hits, ends, lambda hit, stop: F.struct(
            (stop - F.length(hit)).alias("start"), F.lit(kind).alias("kind"), stop.alias("stop"),
            (F.lit(True) if keep is None else keep(hit)).alias("ok")))
        return F.transform(F.filter(spans, lambda s: s["ok"]), lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop")))

    found = _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)
    return F.when(text.rlike(pattern), found.cast(_SPANS)).otherwise(F.array().cast(_SPANS))


def _meets(spans: Column, other: Column) -> Column:
    """Whether ``other`` overlaps one of ``spans``, which are sorted and apart
    from each other: only the last that starts before its end can."""
    before = F.aggregate(F.filter(_powers(falling=True), lambda d: d <= F.size(spans)), F.lit(0), lambda n, d: F.when(
        (n + d <= F.size(spans)) & (F.get(spans, n + d - 1)["start"] < other["stop"]), n + d).otherwise(n))
    return F.coalesce(F.get(spans, before - 1)["stop"] > other["start"], F.lit(False))


def _random_looking(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")


def _listed(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(name, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Secrets of every whole text.

    Returns a row per document: ``id``, ``k1``, ``k2`` (row key), ``base`` and
    ``found`` (sorted arrays of (start, kind, stop): the base findings; these
    and the linked weak candidates).  ``kind`` counts ``KINDS`` from 1.  A
    null or empty text has no spans.  Repeated rows get equal results each.
    An empty table gives no rows.  Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    weak = F.concat(_spans(text, ACCOUNT, 4), _spans(text, BARE, 5, keep=_random_looking), _spans(text, ENDPOINT, 6))
    facts = checkpointed(keyed(docs, id_col, text_col).select(
        "id", "k1", "k2",
        _spans(text, ASSIGN, 1, lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 2)) >= 8).alias("assign"),
        _spans(text, ACCESS, 2).alias("access"), _spans(text, HEX, 3).alias("hex"), weak.alias("weak"))
        .withColumn("base", F.array_sort(F.concat(*KINDS[:3]))))
    # a weak candidate inside a base finding says nothing new
    new = F.filter("weak", lambda w: ~(_meets(F.col("assign"), w) | _meets(F.col("access"), w) | _meets(F.col("hex"), w)))
    one = facts.where(F.size("weak") > 0).select("k1", "k2", "base", new.alias("weak")).where(F.size("weak") > 0)
    role = F.element_at(F.array(*[F.lit(ROLE[k]) for k in KINDS]), F.col("kind"))
    parts = one.select("k1", "k2", F.explode(F.concat("base", "weak")).alias("p")).select(
        "k1", "k2", "p.*").withColumn("role", role).distinct()
    cells = lambda lo, hi: F.explode(F.sequence(F.floor(lo / scope), F.floor(hi / scope)))
    there = parts.withColumn("cell", cells(F.col("start"), F.col("stop"))).alias("b")
    weak = parts.where(F.col("kind") > 3).withColumn(
        "cell", cells(F.greatest(F.col("start") - scope, F.lit(0)), F.col("stop") + scope)).distinct()
    linked = None
    for kind, needs in NEEDS.items():
        got = weak.where(F.col("kind") == KINDS.index(kind) + 1).drop("role").alias("a")
        for need in needs:
            near = ((F.col("a.k1") == F.col("b.k1")) & (F.col("a.k2") == F.col("b.k2"))
                    & (F.col("a.cell") == F.col("b.cell")) & (F.col("b.role") == need)
                    & (((F.col("b.start") >= F.col("a.stop")) & (F.col("b.start") - F.col("a.stop") <= scope))
                       | ((F.col("a.start") >= F.col("b.stop")) & (F.col("a.start") - F.col("b.stop") <= scope))))
            # each cell of the candidate looks for the part; one hit is enough
            hit = got.join(there, near, "left_semi").select("k1", "k2", "kind", "start", "stop").distinct()
            got = got.join(hit.alias("h"), ["k1", "k2", "kind", "start", "stop"], "left_semi").alias("a")
        got = got.select("k1", "k2", F.struct("start", "kind", "stop").alias("span"))
        linked = got if linked is None else linked.union(got)
    linked = linked.groupBy("k1", "k2").agg(F.collect_set("span").alias("linked"))
    return facts.join(linked, ["k1", "k2"], "left").select(
        "id", "k1", "k2", "base",
        F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast(_SPANS)))).alias("found"))


def secrets_digest(found: DataFrame) -> DataFrame:
    """Counts and span lists per document, from :func:`scan_secrets`."""
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        F.col("id").alias("doc_id"), number(1).alias("n_assign"), number(2).alias("n_access"),
        number(3).alias("n_hex"), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"))


def redact(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           mark: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs`` with every found span replaced by ``mark``.

    All columns stay; texts without a finding (and null texts) are unchanged.
    Overlapping spans give one mark.
    """
    k1, k2, spans = free_names(docs, "_k1", "_k2", "_found")
    found = (found.where(F.size("found") > 0).groupBy(F.col("k1").alias(k1), F.col("k2").alias(k2))
             .agg(F.first("found").alias(spans)))
    text, size = F.col(text_col), 1 << _PIECE

    def cut(pieces: Column, start: Column, stop: Column) -> Column:
        """Code points ``start`` to ``stop``, from the pieces they lie in."""
        part = F.transform(F.sequence(F.shiftright(start, _PIECE), F.shiftright(stop - 1, _PIECE)), lambda no: F.substring(
            F.get(pieces, no), F.greatest(start - no * size, F.lit(0)) + 1,
            F.least(stop - no * size, F.lit(size)) - F.greatest(start - no * size, F.lit(0))))
        return F.when(start < stop, F.array_join(part, "")).otherwise("")

    def marked(given: Column) -> Column:
        # a span that starts where all before it have ended gets a mark
        lead = F.transform(given["spans"], lambda s, i: F.struct(
            F.when(i > 0, F.get(given["ends"], i - 1)).otherwise(0).alias("at"), s["start"].alias("start")))
        out = F.transform(F.filter(lead, lambda s: s["start"] >= s["at"]),
                          lambda s: F.concat(cut(given["pieces"], s["at"], s["start"]), F.lit(mark)))
        end = F.get(given["ends"], F.size(given["ends"]) - 1)
        return F.concat(F.array_join(out, ""), cut(given["pieces"], end, given["size"]))

    ends = _let(F.transform(spans, lambda s: s["stop"]), lambda v: _running(v, lambda x, y: F.greatest(x, y)))
    clean = _let(F.struct(F.col(spans).alias("spans"), ends.alias("ends"), F.length(text).alias("size"),
                          F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0)).alias("pieces")), marked)
    keys = {k1: F.xxhash64(id_col), k2: F.xxhash64(id_col, text_col, text.isNull())}
    return (docs.withColumns(keys).join(found, [k1, k2], "left")
            .withColumn(text_col, F.when(F.col(spans).isNull(), text).otherwise(clean)).drop(k1, k2, spans))
