r"""Secret scans: strong patterns, and weak parts of a credential that stand together.

Strong kinds (assign, access, hex) are reported wherever they match. Weak identifiers,
secrets and endpoints are reported only where complementary parts co-occur within a scope
of so many code points: an interval join of the parts of one text. Everything is DataFrame
functions; texts are scanned once, and only lengths and positions are shuffled.

Spark's pattern functions give matches but no positions. The text between two matches comes
from `split` with the same pattern, so a match starts after all earlier lengths of both.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import fresh, stored, text_or_empty

SCOPE = 400  # code points between the starts of two parts of one credential


class Kind(NamedTuple):
    name: str
    part: str  # identifier, secret or endpoint
    strong: bool
    pattern: str
    guard: str  # found in every text that the pattern matches; cheaper
    group: int = 0  # group whose length decides, 0 for the match
    least: int = 1


#: The kinds in the order in which equal starts are listed.
KINDS = (
    Kind("assign", "secret", True, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"(?i:passw|secret|token|api_?key)", 2, 8),
    Kind("access", "identifier", True, r"AKIA[A-Z0-9]+", "AKIA", 0, 16),
    Kind("hex", "secret", True, r"[0-9a-f]{32,}", r"[0-9a-f]{32}"),
    Kind("identifier", "identifier", False, r"""(?i:(access_?key_?id|client_?id|user_?name|user|login|account))["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@+-]+)""", r"(?i:key_?id|client_?id|user|login|account)", 2, 3),
    Kind("secret", "secret", False, r"""(?i:(pwd|passphrase|auth|credential|private_?key|signature))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"(?i:pwd|passphrase|auth|credential|private_?key|signature)", 2, 6),
    Kind("endpoint", "endpoint", False, r"""(?i:https?|jdbc:[a-z0-9]+|postgres|mysql|redis|amqp|s3)://[^\x00-\x20"'<>]+""", "://"),
)
PARTS = ("identifier", "secret", "endpoint")


def lengths_of(text: Column, kind: Kind) -> Column:
    """For each match: length of the text before it back to the last, own length, deciding length.

    The pieces and the matches come in the order of the text; the last piece has no match.
    """
    between = F.split(text, kind.pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    parts = whole if kind.group == 0 else F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group))
    found = F.transform(
        F.arrays_zip(F.slice(between, F.lit(1), F.size(whole)).alias("gap"), whole.alias("own"), parts.alias("part")),
        lambda m: F.struct(F.length(m["gap"]).alias("gap"), F.length(m["own"]).alias("own"), F.length(m["part"]).alias("part")),
    )
    none = F.array().cast("array<struct<gap:int,own:int,part:int>>")
    guarded = F.contains(text, F.lit(kind.guard)) if kind.guard.replace("://", "").isalnum() or kind.guard == "://" else F.rlike(text, F.lit(kind.guard))
    return F.when(guarded, found).otherwise(none)


def matches(texts: DataFrame) -> DataFrame:
    """(key, kind, part, strong, start, end) of every match; `texts` has key and one array per kind."""

    def of_kind(kind: Kind) -> Column:
        return F.transform(
            kind.name,
            lambda m, i: F.struct(
                F.lit(kind.name).alias("kind"),
                F.lit(kind.part).alias("part"),
                F.lit(kind.strong).alias("strong"),
                (m["part"] >= kind.least).alias("good"),
                i.alias("at"),
                m["gap"].cast("long").alias("gap"),
                m["own"].cast("long").alias("own"),
            ),
        )

    rows = texts.select("key", F.inline(F.concat(*[of_kind(k) for k in KINDS])))
    until = Window.partitionBy("key", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("end", F.sum(F.col("gap") + F.col("own")).over(until))
    # failing matches use up their text and go only now
    return placed.filter("good").select("key", "kind", "part", "strong", (F.col("end") - F.col("own")).alias("start"), "end")


def linked_parts(found: DataFrame, scope: int) -> DataFrame:
    """Strong matches, and the weak ones with complementary parts within `scope`.

    A secret needs an identifier or an endpoint, an identifier needs a secret, an endpoint
    needs both. Each text is cut into bins of `scope` code points that keep the first and
    last start of every part; a weak match meets three bins, so no two matches are paired.
    """
    at = F.floor(F.col("start") / scope).alias("bin")
    bins = found.groupBy("key", at).agg(
        *[f(F.when(F.col("part") == p, F.col("start"))).alias(f"{n}_{p}") for p in PARTS for n, f in (("first", F.min), ("last", F.max))]
    )
    weak = found.filter(~F.col("strong")).withColumn("bin", F.explode(F.array(*[F.floor(F.col("start") / scope) + i for i in (-1, 0, 1)])))
    near = {p: (F.col(f"last_{p}") >= F.col("start") - scope) & (F.col(f"first_{p}") <= F.col("start") + scope) for p in PARTS}
    met = weak.join(bins, ["key", "bin"]).groupBy("key", "kind", "part", "strong", "start", "end").agg(
        *[F.coalesce(F.max(near[p]), F.lit(False)).alias(p) for p in PARTS]
    )
    whole = (
        F.when(F.col("part") == "secret", F.col("identifier") | F.col("endpoint"))
        .when(F.col("part") == "identifier", F.col("secret"))
        .otherwise(F.col("identifier") & F.col("secret"))
    )
    return found.filter("strong").unionByName(met.filter(whole).select(*found.columns))


def text_key(text: str) -> Column:
    return F.md5(text_or_empty(text).cast("binary"))


def scan(docs: DataFrame, text: str = "text", id: str | None = None, scope: int = SCOPE) -> tuple[DataFrame, DataFrame]:
    """Stored tables (id, key) of every row and (key, kind, part, strong, start, end) of its text.

    Rows with equal texts share a key and are linked once, so a group of copies is one text
    however large it is. A null text is empty. Starts and ends count code points.
    """
    value = text_or_empty(text)
    ids = [F.col(id).alias("id")] if id else []
    rows = stored(
        docs.select(*ids, text_key(text).alias("key"), *[lengths_of(value, k).alias(k.name) for k in KINDS]), "scanned"
    )
    some = reduce(Column.__or__, [F.size(k.name) > 0 for k in KINDS])
    texts = rows.filter(some).dropDuplicates(["key"])
    found = stored(matches(texts), "matches")
    return rows.select(*(["id"] if id else []), "key"), stored(linked_parts(found, scope), "spans")


def listed(spans: DataFrame) -> DataFrame:
    """(key, spans): the spans of a text by start, then kind, as an array of structs."""
    order = F.element_at(F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k.name), F.lit(i))]), F.col("kind"))
    return spans.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("start", order.alias("kind_order"), "kind", "end"))).alias("spans"))


def found_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every document."""
    rows, spans = scan(docs, id="doc_id")
    told = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    of_kind = lambda n: F.filter("spans", lambda s: s["kind"] == n)
    base = [k.name for k in KINDS if k.strong]
    strong = F.filter("spans", lambda s: s["kind"].isin(*base))
    per_text = listed(spans).select(
        "key",
        *[F.size(of_kind(n)).cast("long").alias(f"n_{n}") for n in base],
        F.array_join(F.transform(strong, told), ",").alias("base"),
        F.array_join(F.transform("spans", told), ",").alias("spans"),
    )
    joined = rows.join(stored(per_text, "listed"), "key", "left")
    return joined.select(
        F.col("id").alias("doc_id"),
        *[F.coalesce(f"n_{n}", F.lit(0).cast("long")).alias(f"n_{n}") for n in base],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", length: str | None = None, scope: int = SCOPE) -> DataFrame:
    """Every row, with `mark` in the text for each run of overlapping spans.

    Rows without a span are unchanged. `length` names a column that then gets the new
    number of code points. Columns keep their names and order.
    """
    _, spans = scan(docs, text, scope=scope)
    order = Window.partitionBy("key").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.select("key", "start", "end", F.when(F.col("start") < reach, 0).otherwise(1).alias("new"))
    runs = marked.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = runs.groupBy("key", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    cuts = merged.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    key, own = fresh(docs, "text_key"), fresh(docs, "cuts")
    cuts = stored(cuts.select(F.col("key").alias(key), F.col("cuts").alias(own)), "cuts")
    joined = docs.withColumn(key, text_key(text)).join(cuts, key, "left")
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(own, lambda c: c["end"]))
    ends = F.concat(F.transform(own, lambda c: c["start"]), F.array(F.length(text).cast("long")))
    pieces = F.transform(
        F.arrays_zip(starts.alias("a"), ends.alias("b")),
        lambda e: F.substring(F.col(text), (e["a"] + 1).cast("int"), (e["b"] - e["a"]).cast("int")),
    )
    clean = F.when(F.col(own).isNotNull(), F.array_join(pieces, mark)).otherwise(F.col(text))
    out = joined.withColumn(text, clean)
    if length and length in docs.columns:
        out = out.withColumn(length, F.when(F.col(own).isNotNull(), F.length(text).cast(docs.schema[length].dataType)).otherwise(F.col(length)))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def secrets_sql(scope: int = SCOPE) -> str:
    """The same rows as `found_secrets` in SQL."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    kinds = " union all ".join(
        f"select doc_id, '{k.name}' as kind, {i} as kind_order, '{k.part}' as part, {str(k.strong).lower()} as strong, {k.least} as least, "
        f"string_split_regex(t, {quoted(k.pattern)}) as between, regexp_extract_all(t, {quoted(k.pattern)}, 0) as whole, "
        f"regexp_extract_all(t, {quoted(k.pattern)}, {k.group}) as parts from texts"
        for i, k in enumerate(KINDS)
    )
    near = lambda p: f"exists (select 1 from found f where f.doc_id = w.doc_id and f.part = '{p}' and abs(f.start - w.start) <= {scope})"
    count = lambda k: f"cast(count(*) filter (kind = '{k}') as bigint) as n_{k}"
    listing = "string_agg(concat_ws(':', kind, start, stop), ',' order by start, kind_order, stop)"
    base = "kind in (" + ", ".join(f"'{k.name}'" for k in KINDS if k.strong) + ")"
    return f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
each as (select *, unnest(range(1, len(whole) + 1)) as i from ({kinds})),
placed as (
    select doc_id, kind, kind_order, part, strong, length(whole[i]) as own, length(parts[i]) >= least as good,
        sum(length(between[i]) + length(whole[i])) over (partition by doc_id, kind order by i) as stop
    from each
),
found as (select doc_id, kind, kind_order, part, strong, cast(stop - own as bigint) as start, cast(stop as bigint) as stop from placed where good),
spans as (
    select * from found w where strong
        or part = 'secret' and ({near("identifier")} or {near("endpoint")})
        or part = 'identifier' and {near("secret")}
        or part = 'endpoint' and {near("identifier")} and {near("secret")}
),
listed as (
    select doc_id, {", ".join(count(k.name) for k in KINDS if k.strong)}, {listing} filter ({base}) as base, {listing} as spans from spans group by doc_id
)
select doc_id, {", ".join(f"coalesce(n_{k.name}, 0) as n_{k.name}" for k in KINDS if k.strong)},
    sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from texts left join listed using (doc_id)
"""
