"""Secret scans by multipart credential linking, with Spark's own functions only.

Base spans are found by pattern. Beside them the scan finds weak parts (named identifiers, random
looking strings, endpoints), which alone prove nothing; parts are joined as intervals within a
scope of ``scope_chars`` around each, and a weak part is reported only when the parts that complete
it stand in its scope:

* ``weak_secret``: a random looking string with an identifier or access key in scope;
* ``weak_id``: a named identifier with a secret (assigned or weak) in scope;
* ``endpoint``: a service address with both an identifier and a secret in scope.

Positions are code points, ends exclusive. All work stays in the row: no shuffle, no Python. Spans of a
kind don't overlap, so they are in order by start and by end, and the join finds the first part that
ends behind the begin of a scope by bisection. Running sums go by stretches of CHUNK values, so that
no array grows value by value: the work in a text is that of its length times the logarithm of its parts.
Defined results: a null or empty text has no spans; very long texts are scanned whole; spans that begin
together stand in order of their kinds; repeated rows give equal rows; an empty table gives no rows;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base patterns, with runs below the least length left out by the pattern where that is the same.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
MIN_ASSIGNED = 6

WEAK_ID = r"""(?i)(?:access_?key(?:_?id)?|client_?id|account(?:_?id)?|user(?:name)?|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+/_.-]{4,})"""
WEAK_SECRET = r"[A-Za-z0-9+/]{32,}={0,2}"
ENDPOINT = r"""(?:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3|ftp)://[A-Za-z0-9._~:/?#@%&=+-]+"""

PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "weak_id": WEAK_ID, "weak_secret": WEAK_SECRET, "endpoint": ENDPOINT}
BASE = ("assign", "access", "hex")
SCOPE_CHARS = 300
CHUNK = 256
MASK_CHARS = 4096  # in which texts are masked
_SPAN = "array<struct<start:int,rank:int,end:int>>"


def _barrier(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """Adds columns through a one-row generator, so that later lambdas read values, not expressions."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _stretches(values: Column, first: Column, value: Callable[[Column], Column], step: Callable[[Column, Column], Column]) -> Column:
    """array<struct<all, before>>: of each CHUNK values the total, and what comes before each of them within."""

    def add(acc: Column, x: Column) -> Column:
        return F.struct(step(acc["all"], value(x)).alias("all"), F.concat(acc["before"], F.array(acc["all"])).alias("before"))

    none = F.struct(first.alias("all"), F.array().cast("array<int>").alias("before"))
    last = F.floor((F.size(values) - 1) / CHUNK).cast("int")
    walked = F.transform(F.sequence(F.lit(0), last), lambda c: F.aggregate(F.slice(values, c * CHUNK + 1, CHUNK), none, add))
    return F.when(F.size(values) > 0, walked).otherwise(F.array().cast("array<struct<all:int,before:array<int>>>"))


def _offsets(stretches: Column, first: Column, step: Callable[[Column, Column], Column]) -> Column:
    """What comes before each stretch."""
    none = F.struct(first.alias("all"), F.array().cast("array<int>").alias("before"))
    return F.aggregate(stretches, none, lambda acc, x: F.struct(step(acc["all"], x["all"]).alias("all"), F.concat(acc["before"], F.array(acc["all"])).alias("before")), lambda acc: acc["before"])


def _before(rows: DataFrame, keep: list[str], arrays: dict[str, tuple[Column, Callable[[Column], Column]]], first: Column, step: Callable[[Column, Column], Column]) -> DataFrame:
    """Adds for each array, as ``name``, the array, and as ``name_before`` what its values before each come to."""
    rows = _barrier(rows, keep, **{n: a for n, (a, _) in arrays.items()})
    rows = _barrier(rows, [*keep, *arrays], **{f"{n}_s": _stretches(F.col(n), first, value, step) for n, (_, value) in arrays.items()})
    rows = _barrier(rows, [*keep, *arrays, *[f"{n}_s" for n in arrays]], **{f"{n}_o": _offsets(F.col(f"{n}_s"), first, step) for n in arrays})

    def whole(n: str) -> Column:
        return F.flatten(F.transform(f"{n}_s", lambda x, i: F.transform(x["before"], lambda v: step(F.get(f"{n}_o", i), v))))

    return _barrier(rows, [*keep, *arrays], **{f"{n}_before": whole(n) for n in arrays})


def _pairs(found: Column, text: Column, kind: str) -> Column:
    """Matches, each with the gap in front of it and whether it counts."""
    ok = lambda x: F.lit(True)
    if kind == "assign":
        ok = lambda x: F.length(F.regexp_extract(x, ASSIGN, 2)) >= MIN_ASSIGNED
    elif kind == "weak_secret":
        ok = lambda x: x.rlike("[0-9]") & x.rlike("[a-z]") & x.rlike("[A-Z]")
    zipped = F.arrays_zip(F.transform(F.split(text, PATTERNS[kind], -1), F.length).alias("gap"), found.alias("hit"))
    pairs = F.transform(F.slice(zipped, 1, F.size(found)), lambda x: F.struct(x["gap"].alias("gap"), F.length(x["hit"]).alias("size"), ok(x["hit"]).alias("ok")))
    return F.when(F.size(found) > 0, pairs).otherwise(F.array().cast("array<struct<gap:int,size:int,ok:boolean>>"))


def _spans(kind: str) -> Column:
    """Each match starts where the gaps and matches before it, and its own gap, end."""
    rank = list(PATTERNS).index(kind)
    placed = F.zip_with(kind, f"{kind}_before", lambda x, at: F.when(x["ok"], F.struct((at + x["gap"]).alias("start"), F.lit(rank).alias("rank"), (at + x["gap"] + x["size"]).alias("end"))))
    return F.filter(placed, lambda x: x.isNotNull())


def _first_ending_after(parts: Column, at: Column) -> Column:
    """How many of the parts, which are in order, end at or before a place: by bisection."""

    def halve(acc: Column, _: Column) -> Column:
        mid = F.shiftright(acc["lo"] + acc["hi"], 1)
        behind = F.get(parts, mid)["end"] > at
        open_ = acc["lo"] < acc["hi"]
        return F.struct(F.when(open_ & ~behind, mid + 1).otherwise(acc["lo"]).alias("lo"), F.when(open_ & behind, mid).otherwise(acc["hi"]).alias("hi"))

    rounds = F.sequence(F.lit(1), F.length(F.bin(F.size(parts))))
    return F.aggregate(rounds, F.struct(F.lit(0).alias("lo"), F.size(parts).alias("hi")), halve, lambda acc: acc["lo"])


def _near(x: Column, kinds: list[str], scope: int) -> Column:
    """Interval join within the row: is a part of these kinds in the scope of x?"""
    found = F.lit(False)
    for k in kinds:
        parts = F.col(k)
        first = F.get(parts, _first_ending_after(parts, x["start"] - scope))
        found = found | ((F.size(parts) > 0) & F.coalesce(first["start"] < x["end"] + scope, F.lit(False)))
    return found


def _scan(rows: DataFrame, scope_chars: int) -> DataFrame:
    """Adds base and added to rows with a column _text; spans still as struct(start, rank, end)."""
    keep = rows.columns
    rows = _barrier(rows, keep, **{f"_{k}": F.regexp_extract_all("_text", F.lit(p), F.lit(0)) for k, p in PATTERNS.items()})
    pairs = {k: (_pairs(F.col(f"_{k}"), F.col("_text"), k), lambda x: x["gap"] + x["size"]) for k in PATTERNS}
    rows = _before(rows, keep, pairs, F.lit(0), lambda a, b: a + b)
    rows = _barrier(rows, keep, **{k: _spans(k) for k in PATTERNS})
    # A weak part that a base span covers is that base span, nothing new.
    apart = lambda k: F.when(F.size(k) > 0, F.filter(k, lambda x: ~_near(x, list(BASE), 0))).otherwise(F.col(k))
    rows = _barrier(rows, keep, base=F.array_sort(F.concat(*BASE)), **{k: F.col(k) if k in BASE else apart(k) for k in PATTERNS})
    ids = ["access", "weak_id"]
    rows = _barrier(rows, [*keep, "base", "assign", *ids, "endpoint"], weak=F.filter("weak_secret", lambda x: _near(x, ids, scope_chars)))
    secrets = ["assign", "weak"]
    added = F.concat(
        F.filter("weak_id", lambda x: _near(x, secrets, scope_chars)),
        F.col("weak"),
        F.filter("endpoint", lambda x: _near(x, secrets, scope_chars) & _near(x, ids, scope_chars)),
    )
    return _barrier(rows, [*keep, "base"], added=F.array_sort(added))


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", scope_chars: int = SCOPE_CHARS) -> DataFrame:
    """(id, base, added): arrays of struct(kind, start, end), each by start, then kind as listed."""
    found = _scan(docs.select(F.col(id_col).alias("_0"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")), scope_chars)
    names = F.array(*[F.lit(k) for k in PATTERNS])

    def named(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(F.element_at(names, s["rank"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    return found.select(F.col("_0").alias(id_col), named(F.col("base")).alias("base"), named(F.col("added")).alias("added"))


def redact_secrets(docs: DataFrame, *, text_col: str = "text", mask: str = "[SECRET]", scope_chars: int = SCOPE_CHARS) -> DataFrame:
    """The rows with base spans and linked weak secrets masked in their text, all columns kept.

    Spans that overlap share one mask; a null text stays null."""
    names = docs.columns
    held = [f"_{i}" for i in range(len(names))]  # under names of their own, whatever theirs are
    rows = docs.select(*[F.col(f"`{n}`").alias(h) for n, h in zip(names, held, strict=True)], F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    weak = list(PATTERNS).index("weak_secret")
    found = _scan(rows, scope_chars)
    spans = F.array_sort(F.concat("base", F.filter("added", lambda s: s["rank"] == weak)))
    held.append("_text")
    found = _before(found, held, {"spans": (spans, lambda s: s["end"])}, F.lit(0), F.greatest)
    # A span that starts where all before it have ended begins a mask, which reaches to the next such span's predecessors.
    begins = F.filter(F.zip_with("spans", "spans_before", lambda s, b: F.when(s["start"] >= b, F.struct(s["start"].alias("start"), b.alias("before")))), lambda x: x.isNotNull())
    found = _barrier(found, [*held, "spans"], begins=begins, last=F.aggregate("spans", F.lit(0), lambda a, s: F.greatest(a, s["end"])))
    masks = F.transform("begins", lambda x, i: F.struct(x["start"].alias("start"), F.coalesce(F.get("begins", i + 1)["before"], F.col("last")).alias("end")))
    chunks = F.regexp_extract_all("_text", F.lit(f"(?s).{{1,{MASK_CHARS}}}"), F.lit(0))
    found = _barrier(found, held, masks=masks, chunks=F.when(F.size("spans") > 0, chunks).otherwise(F.array().cast("array<string>")))

    def masked(chunk: Column, i: Column) -> Column:
        """A chunk without what masks cover; a mask stands where it begins."""
        begin = i * MASK_CHARS
        stop = begin + F.length(chunk)
        first = _first_ending_after(F.col("masks"), begin)
        here = F.slice("masks", first + 1, _first_ending_after(F.col("masks"), stop) - first + 1)

        def step(acc: Column, m: Column) -> Column:
            plain = F.substring(chunk, acc["at"] - begin + 1, m["start"] - acc["at"])
            inside = (m["start"] >= begin) & (m["start"] < stop)
            out = F.when(inside, F.concat(acc["out"], plain, F.lit(mask))).otherwise(acc["out"])
            return F.struct(F.when(m["start"] < stop, F.greatest(acc["at"], m["end"])).otherwise(acc["at"]).alias("at"), out.alias("out"))

        start = F.struct(begin.alias("at"), F.lit("").alias("out"))
        return F.aggregate(here, start, step, lambda acc: F.when(acc["at"] < stop, F.concat(acc["out"], F.substring(chunk, acc["at"] - begin + 1, F.length(chunk)))).otherwise(acc["out"]))

    text = F.when(F.size("masks") > 0, F.array_join(F.transform("chunks", masked), "")).otherwise(F.col(held[names.index(text_col)]))
    return found.select(*[text.alias(n) if n == text_col else F.col(h).alias(n) for n, h in zip(names, held[:-1], strict=True)])


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def merged(base: Column, added: Column) -> Column:
    """All spans by start, then kind as listed."""
    order = F.map_from_arrays(F.array(*[F.lit(k) for k in PATTERNS]), F.array(*[F.lit(i) for i in range(len(PATTERNS))]))
    keyed = F.transform(F.concat(base, added), lambda s: F.struct(s["start"].alias("start"), F.element_at(order, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_sort(keyed)
