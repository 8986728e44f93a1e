"""Secret scan with multipart credential linking, with DataFrame functions only.

Base patterns are found on their own. Weak parts (short access identifiers, secret-like strings, endpoints)
are reported only where a part of another role lies beside them, with at most :data:`SCOPE` code points between the two;
parts that overlap are no company for each other. What stands inside an endpoint is no weak secret, but for the
password before its host.

Linking is an interval join over the parts of one text: the ends (starts) of parts and the places that look for one are
sorted together and cut into blocks; a place finds its match in its own block, or the nearest of each role that earlier
blocks carry over. It is exact for parts of any length and number, and no text or part is shuffled.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: name, pattern, least length, group that the least length holds for, role. Base kinds first; fixed values.
BASE = (
    ("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 2, "secret"),
    ("access", r"AKIA[A-Z0-9]{16,}", 20, 0, "access"),
    ("hex", r"[0-9a-f]{24,}", 24, 0, "secret"),
)
#: A string of the form of an access identifier is not a weak secret too, else it would be its own company.
_ACCESS = r"(?:AKIA|ASIA|AGPA|AIDA|AROA)[A-Z0-9]{8,}+={0,2}(?![A-Za-z0-9+/=])"
_SCHEME = r"(?:https?|s3|ftp|postgres|mysql|mongodb|redis|amqp)://"
_PLACE = r"[A-Za-z0-9._~:/?#@%&=+-]{4,}+"
#: What a secret is not looked for in: an endpoint as a whole, or around the password that stands before its host.
_PASSED = rf"{_SCHEME}[A-Za-z0-9._~%+-]*+:(?=[A-Za-z0-9._~/%&=+-]++@)|{_SCHEME}{_PLACE}|(?<=[A-Za-z0-9])@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+[:/?#]{_PLACE}"
WEAK = (
    ("weak_access", r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{8,15}|(?:ASIA|AGPA|AIDA|AROA)[A-Z0-9]{8,}+)(?![A-Za-z0-9])", 12, 0, "access"),
    ("weak_secret", rf"{_PASSED}|((?<![A-Za-z0-9+/=])(?!{_ACCESS})(?=[A-Za-z+/]*[0-9])(?=[a-z0-9+/]*[A-Z])[A-Za-z0-9+/]{{16,}}+={{0,2}}(?![A-Za-z0-9+/=]))", 16, 1, "secret"),
    ("weak_endpoint", rf"{_SCHEME}{_PLACE}", 8, 0, "endpoint"),
)
KINDS = BASE + WEAK
ROLES = sorted({role for *_, role in KINDS})
SCOPE = 240
#: Elements of a block: prefix sums and the join work block by block, since arrays that grow step by step cost the square.
BLOCK = 64

PART = "struct<start: int, rank: int, kind: string, end: int, role: string, base: boolean>"

#: Plain strings without which a kind can't occur; a quick test before the pattern.
NEEDS = {
    "access": "AKIA",
    "weak_endpoint": "://",
}


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once: inside a lambda, an expression is computed for each element."""
    return F.transform(F.array(value), use)[0]


def _blocks(items: Column) -> Column:
    """The array cut into arrays of :data:`BLOCK` elements."""
    none = F.expr("CAST(array() AS array<int>)")

    def cut(x):
        numbers = F.when(F.size(x) > 0, F.sequence(F.lit(0), F.floor((F.size(x) - 1) / BLOCK).cast("int"))).otherwise(none)
        return F.transform(numbers, lambda b: F.slice(x, b * BLOCK + 1, BLOCK))

    return _once(items, cut)


def _sums(lengths: Column) -> Column:
    """Where each of some lengths begins, run together, and where the last ends."""
    begin = F.array(F.lit(0))
    return F.aggregate(lengths, begin, lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x)))


def _found(text: Column, rank: int) -> Column:
    """The kind's matches in ``text`` with their places: gaps and matches alternate, so lengths give starts."""
    name, pattern, least, group, role = KINDS[rank]
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    held = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    gaps = F.split(text, pattern, -1)
    lengths = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("own")))

    def step(done, x):
        start = done["at"] + x["gap"]
        return F.struct(
            (start + x["own"]).alias("at"),
            F.concat(done["spans"], F.array(F.struct(start.alias("start"), (start + x["own"]).alias("end")))).alias("spans"),
        )

    begin = F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<struct<start: int, end: int>>)").alias("spans"))
    blocks = F.transform(_blocks(lengths), lambda block: F.aggregate(block, begin, step))

    def placed(blocks):
        first = F.slice(_sums(F.transform(blocks, lambda block: block["at"])), 1, F.size(blocks))
        moved = lambda at: lambda s: F.struct((s["start"] + at).alias("start"), (s["end"] + at).alias("end"))
        return F.flatten(F.zip_with(blocks, first, lambda block, at: F.transform(block["spans"], moved(at))))

    spans = _once(blocks, placed)
    parts = F.zip_with(
        spans,
        held,
        lambda s, h: F.struct(
            s["start"].alias("start"),
            F.lit(rank).alias("rank"),
            F.lit(name).alias("kind"),
            s["end"].alias("end"),
            F.lit(role).alias("role"),
            F.lit(rank < len(BASE)).alias("base"),
            F.length(h).alias("held"),
        ),
    )
    parts = F.transform(F.filter(parts, lambda p: p["held"] >= least), lambda p: p.dropFields("held")).cast(f"array<{PART}>")
    likely = text.contains(NEEDS[name]) if name in NEEDS else F.regexp_like(text, F.lit(pattern))
    return F.when(likely, parts).otherwise(F.expr(f"CAST(array() AS array<{PART}>)"))


def secret_spans(text: Column) -> Column:
    """Base spans and linked weak spans of a text, by start, then kind as listed; empty for null.

    Starts and ends are code points, end exclusive.
    """
    text = F.coalesce(text, F.lit(""))
    return F.array_sort(F.concat(*(_found(text, rank) for rank in range(len(KINDS)))))


def _met(parts: Column, backwards: bool = False) -> Column:
    """Per part, in order, whether one of another role ends before it (begins after it if ``backwards``) within the scope."""
    end, start = (lambda p: -p["start"], lambda p: -p["end"]) if backwards else (lambda p: p["end"], lambda p: p["start"])
    event = lambda at, looks, i, p: F.struct(at.alias("at"), F.lit(looks).alias("looks"), i.alias("i"), p["role"].alias("role"))
    # At one place the ends come first: parts that touch are beside each other.
    events = F.array_sort(
        F.concat(F.transform(parts, lambda p, i: event(end(p), 0, i, p)), F.transform(parts, lambda p, i: event(start(p), 1, i, p)))
    )
    last = lambda block, role: F.array_max(
        F.transform(F.filter(block, lambda e: (e["looks"] == 0) & (e["role"] == role)), lambda e: e["at"])
    )
    none = F.lit(None).cast("int")

    def carry(done, block):
        before = F.element_at(done, -1)
        # Of null and a number, the greatest is the number.
        return F.concat(done, F.array(F.struct(*(F.greatest(before[role], last(block, role)).alias(role) for role in ROLES))))

    def looked(block, before):
        def hit(e):
            inside = F.exists(block, lambda q: (q["looks"] == 0) & (q["role"] != e["role"]) & (q["at"] <= e["at"]) & (e["at"] - q["at"] <= SCOPE))
            earlier = [(e["role"] != role) & (e["at"] - before[role] <= SCOPE) for role in ROLES]
            return inside | F.coalesce(functools.reduce(lambda a, b: a | b, earlier), F.lit(False))

        return F.transform(F.filter(block, lambda e: e["looks"] == 1), lambda e: F.struct(e["i"].alias("i"), hit(e).alias("hit")))

    def found(blocks):
        carried = F.aggregate(blocks, F.array(F.struct(*(none.alias(role) for role in ROLES))), carry)
        return F.flatten(F.zip_with(blocks, F.slice(carried, 1, F.size(blocks)), looked))

    return F.transform(F.array_sort(_once(_blocks(events), found)), lambda f: f["hit"])


def linked(parts: Column) -> Column:
    """The base parts, and the weak ones beside a part of another role; ``parts`` are sorted by start."""
    near = F.zip_with(_met(parts), _met(parts, backwards=True), lambda a, b: a | b)
    found = F.filter(F.zip_with(parts, near, lambda part, n: F.when(part["base"] | n, part)), lambda part: part.isNotNull())
    base = F.filter(parts, lambda part: part["base"])
    mixed = F.exists(parts, lambda part: ~part["base"]) & F.exists(parts, lambda part: part["role"] != parts[0]["role"])
    return F.when(mixed, found).otherwise(base)


def with_secrets(documents: DataFrame) -> DataFrame:
    """The documents with a column ``spans`` in place of any of that name: array of ``{start, rank, kind, end, role, base}``.

    Null and empty texts have none. Each row is scanned on its own, so repeated rows repeat their spans.
    """
    return documents.withColumn("spans", secret_spans(F.col("text"))).withColumn("spans", linked(F.col("spans")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(documents: DataFrame) -> DataFrame:
    """``doc_id``, base matches by kind, a digest of the base spans, and all spans."""
    found = with_secrets(documents.select("doc_id", "text")).drop("text")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind, *_ in BASE),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def redacted(documents: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents, same columns, with every reported span replaced by ``mark``; ``n_chars`` follows if present.

    Overlapping spans are replaced together. Null texts stay null.
    """
    spans, out = "__spans", "__text"
    found = documents.withColumn(spans, secret_spans(F.col("text"))).withColumn(spans, linked(F.col(spans)))

    # Each block of spans rebuilds the text from where the earlier ones end to where it ends itself.
    blocks = F.transform(_blocks(F.col(spans)), lambda block: F.struct(block.alias("spans"), F.array_max(F.transform(block, lambda s: s["end"])).alias("end")))
    ends = lambda blocks: F.aggregate(
        blocks, F.array(F.lit(0)), lambda done, block: F.concat(done, F.array(F.greatest(F.element_at(done, -1), block["end"])))
    )

    def rebuilt(block, low):
        own = F.substr(F.col("text"), low + 1, F.greatest(block["end"] - low, F.lit(0)))

        def step(done, s):
            gap = F.substr(done["own"], done["at"] - low + 1, s["start"] - done["at"])
            out = F.when(s["start"] >= done["at"], F.concat(done["out"], gap, F.lit(mark))).otherwise(done["out"])
            return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"), done["own"].alias("own"))

        begin = F.struct(low.alias("at"), F.lit("").alias("out"), own.alias("own"))
        return F.aggregate(block["spans"], begin, step, lambda done: done["out"])

    def joined(blocks):
        pieces = F.zip_with(blocks, F.slice(ends(blocks), 1, F.size(blocks)), rebuilt)
        return F.concat(F.array_join(pieces, ""), F.substr(F.col("text"), F.element_at(ends(blocks), -1) + 1))

    whole = _once(blocks, joined)
    text = F.when(F.size(spans) > 0, whole).otherwise(F.col("text"))
    changed = found.withColumn(out, text)
    columns = {"text": F.col(out)}
    if "n_chars" in documents.columns:
        columns["n_chars"] = F.when(F.size(spans) > 0, F.length(out).cast("long")).otherwise(F.col("n_chars"))
    return changed.select(*(columns.get(c, F.col(f"`{c}`")).alias(c) for c in documents.columns))
