"""Secrets in texts, with multipart credentials linked, in DataFrame operations only.

Strong patterns are reported wherever they stand. Weak candidates, which alone would be noise, are
reported only when complementary parts of a credential lie in their scope: the parts of a text (access
identifiers, secrets, endpoints) are rows with intervals, a part's scope is its interval widened by
``SCOPE`` code points on both sides, and an interval join within the text finds the partners.

- a weak identifier (a short access id, or an assigned user, account or client id) needs a secret;
- a weak secret (a whole run of 32 base64 characters or more with upper case, lower case and digits) needs an identifier;
- an endpoint (a URL or a host of a cloud service) needs both an identifier and a secret.

The interval join is a semi-join on (text, bin): a partner's scope stands in every bin it touches, a candidate
in the bins of its first and its last character, and no pairs are made. As a partner lies wholly before or behind
the candidate, its scope meets the candidate only if it covers one of the two. A bin holds as many parts as fit in ``SCOPE`` characters,
however long the text. Only parts travel, keyed by the id and a hash of the text; texts stay where they are.

Defined results: null text counts as empty; null ids match each other; repeated rows give the same spans
each; an empty table gives no rows; only the id and the text are read, so other columns may have any name.
Spans are of the whole match, in code points, the end exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdmloom.llm.common import stored, whole_text

# The strong patterns, as contracts fix them.
ASSIGN = (
    "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
# The weak ones.
SHORT_ID = "A(?:KIA|SIA|GPA|IDA|ROA)[A-Z0-9]{8,}"
# A name may follow an underscore, or begin with a capital within a word (dbUser).
NAMED_ID = "(?i)(?:(?<![A-Za-z0-9])|(?-i:(?<=[a-z0-9])(?=[A-Z])))(?:user|username|login|account|client_?id|access_?key_?id)[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9_.@-]{3,}"
BASE64 = "[A-Za-z0-9+/_-]{32,}={0,2}"
# No group is repeated, as the matcher would take a stack frame for each turn, and a run of host characters is entered at its start only.
ENDPOINT = "(?i)(?<![A-Za-z0-9])[a-z][a-z0-9+.-]{1,12}://[^\\s\"'<>]{4,}+|(?<![A-Za-z0-9.-])[a-z0-9.-]*\\.(?:amazonaws\\.com|windows\\.net|googleapis\\.com)\\b"

#: Kinds in the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "id", "secret", "endpoint")
BASE_KINDS = KINDS[:3]
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: Code points between the parts of one credential, at most.
SCOPE = 400

#: Elements that are scanned by appending; parts into which a list of pieces is cut, on each of so many levels.
CHUNK = 256
BRANCH = 100
LEVELS = 2

SPAN = "struct<kind:string,start:int,end:int>"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value bound to a variable, so that it is computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def _scanned(numbers: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running sums or maxima of an array of whole numbers from 0 up.

    Appending copies an array, so chunks are scanned one by one, then the chunks' totals, and both are put together:
    the work stays close to the length of the array, however long.
    """

    def appended(values: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        step = lambda state, x: _once(combine(state["at"], x), lambda at: F.struct(at.alias("at"), F.concat(state["out"], F.array(at)).alias("out")))
        return F.aggregate(values, start, step)["out"]

    def chunked(values: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int")))
        return F.transform(places, lambda i: appended(F.slice(values, i * CHUNK + 1, F.lit(CHUNK))))

    def joined(chunks: Column) -> Column:
        totals = appended(F.transform(chunks, lambda c: F.coalesce(F.try_element_at(c, F.lit(-1)), F.lit(0))))
        with_totals = lambda before: F.transform(
            chunks, lambda c, i: F.when(i == 0, c).otherwise(F.transform(c, lambda x: combine(F.get(before, i - 1), x)))
        )
        return F.flatten(_once(totals, with_totals))

    return _once(numbers, lambda values: _once(chunked(values), joined))


def spans(text: Column, pattern: str, kind: str, least: int = 0, group: int = 0, test: Callable[[Column], Column] | None = None) -> Column:
    """Leftmost non-overlapping matches as (kind, start, end); ``group`` needs ``least`` characters, the match must pass ``test``.

    The text between matches is what ``split`` leaves, so places are running sums of lengths. A text is gone through a fixed number
    of times, however long and however many its matches.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    keep = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda x: F.length(x) >= least) if least else None
    if test is not None:
        keep = F.transform(found, test)
    sizes = F.transform(found, lambda x: F.length(x))
    # The last gap has no match behind it.
    steps = F.zip_with(F.transform(F.split(text, pattern, -1), lambda x: F.length(x)), sizes, lambda gap, size: gap + size)
    ends = _scanned(F.filter(steps, lambda x: x.isNotNull()), lambda a, b: a + b)
    fields = [ends.alias("end"), sizes.alias("size")] + ([] if keep is None else [keep.alias("keep")])
    rows = F.arrays_zip(*fields)
    if keep is not None:
        rows = F.filter(rows, lambda r: r["keep"])
    made = F.transform(rows, lambda r: F.struct(F.lit(kind).alias("kind"), (r["end"] - r["size"]).alias("start"), r["end"].alias("end")))
    return F.when(text.rlike(pattern), made).otherwise(F.array().cast(f"array<{SPAN}>"))


def found_parts(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, h, assign, access, hex, weak): the strong spans of each kind, and the weak candidates. Stored."""
    t = F.col("text")
    long_hex = f"[0-9a-f]{{{LEAST['hex']},}}"  # a run is taken whole, so this finds the runs that pass
    weak = F.concat(
        spans(t, SHORT_ID, "id"),
        spans(t, NAMED_ID, "id"),
        spans(t, BASE64, "secret", test=_mixed),
        spans(t, ENDPOINT, "endpoint"),
    )
    rows = docs.select(F.col(id).alias("id"), whole_text(text).alias("text"))
    return stored(
        rows.select(
            "id",
            F.xxhash64("text").alias("h"),
            spans(t, ASSIGN, "assign", LEAST["assign"], 1).alias("assign"),
            spans(t, ACCESS, "access", LEAST["access"]).alias("access"),
            spans(t, long_hex, "hex", LEAST["hex"]).alias("hex"),
            weak.alias("weak"),
        ),
        "secrets",
    )


def _mixed(s: Column) -> Column:
    return s.rlike("[A-Z]") & s.rlike("[a-z]") & s.rlike("[0-9]")


def _outside(weak: Column, strong: Column) -> Column:
    """The weak candidates less those that lie whole in one strong span, which are reported with it.

    In the order of starts a candidate lies in a strong span if the furthest end of the strong ones so far reaches its end.
    """
    item = lambda s, rank: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))
    items = F.array_sort(F.concat(F.transform(strong, lambda s: item(s, 0)), F.transform(weak, lambda s: item(s, 1))))

    def open_(items: Column) -> Column:
        reach = _scanned(F.transform(items, lambda x: F.when(x["rank"] == 0, x["end"]).otherwise(0)), lambda a, b: F.greatest(a, b))
        kept = F.filter(F.zip_with(items, reach, lambda x, r: F.struct(x.alias("x"), r.alias("r"))), lambda y: (y["x"]["rank"] == 1) & (y["r"] < y["x"]["end"]))
        return F.transform(kept, lambda y: F.struct(y["x"]["kind"].alias("kind"), y["x"]["start"].alias("start"), y["x"]["end"].alias("end")))

    return _once(items, open_)


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(id, h, linked): the weak candidates with complementary parts in scope, for the texts that have any."""
    texts = found.where(F.size("weak") > 0).select("id", "h", "assign", "access", "hex", "weak").dropDuplicates(["id", "h"])
    strong = F.concat("assign", "access", "hex")
    parts = texts.select("id", "h", F.explode(F.concat(strong, "weak")).alias("s")).select("id", "h", "s.*")
    role = F.when(F.col("kind").isin("access", "id"), "id").when(F.col("kind") == "endpoint", "endpoint").otherwise("secret")
    parts = parts.withColumn("role", role)
    weak = texts.select("id", "h", F.explode(_outside(F.col("weak"), strong)).alias("s")).select("id", "h", "s.*")

    def scopes(kind: str) -> DataFrame:
        """Each part's scope, once for each bin that it touches."""
        begin, end = F.col("start") - scope, F.col("end") + scope
        return parts.where(F.col("role") == kind).select(
            F.col("id").alias("pid"),
            F.col("h").alias("ph"),
            begin.alias("begin"),
            end.alias("until"),
            F.col("start").alias("pstart"),
            F.col("end").alias("pend"),
            F.explode(F.sequence(F.floor(begin / scope), F.floor(end / scope))).alias("pbin"),
        )

    def having(rows: DataFrame, kind: str) -> DataFrame:
        other = scopes(kind)
        apart = (F.col("pend") <= F.col("start")) | (F.col("end") <= F.col("pstart"))
        ends = F.array_distinct(F.array(F.floor(F.col("start") / scope), F.floor((F.col("end") - 1) / scope)))
        return rows.withColumn("bin", F.explode(ends)).join(
            other,
            (F.col("h") == F.col("ph"))
            & F.col("id").eqNullSafe(F.col("pid"))
            & (F.col("bin") == F.col("pbin"))
            & (F.col("start") < F.col("until"))
            & (F.col("begin") < F.col("end"))
            & apart,
            "left_semi",
        ).drop("bin")

    of = lambda kind: weak.where(F.col("kind") == kind)
    kept = having(of("id"), "secret").unionByName(having(of("secret"), "id")).unionByName(having(having(of("endpoint"), "id"), "secret"))
    return kept.groupBy("id", "h").agg(F.collect_set(F.struct("kind", "start", "end")).alias("linked"))


def _ordered(found: Column) -> Column:
    """By start, then kind as listed, then end; as text ``kind:start:end``, comma-joined."""
    rank = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    keyed = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """(id, h, n_assign, n_access, n_hex, n_linked, base_spans, spans, found) of every document.

    ``found`` has the spans as structs; h is a hash of the text, with which (id, h) finds it again.
    """
    found = found_parts(docs, id, text)
    extra = linked(found, scope)
    left, right = found.alias("f"), extra.alias("e")
    rows = left.join(right, F.col("f.id").eqNullSafe(F.col("e.id")) & (F.col("f.h") == F.col("e.h")), "left").select("f.*", "linked")
    base = F.concat("assign", "access", "hex")
    every = F.concat(base, F.coalesce(F.col("linked"), F.array().cast(f"array<{SPAN}>")))
    return rows.select(
        F.col("id").alias(id),
        "h",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.coalesce(F.size("linked"), F.lit(0)).cast("long").alias("n_linked"),
        _ordered(base).alias("base_spans"),
        _ordered(every).alias("spans"),
        every.alias("found"),
    )


def _pieces_of(text: Column, begin: Column, pieces: Column, mask: str, level: int) -> Column:
    """The pieces [start, end) of a text that begins at place ``begin``, each with ``mask`` behind it, as one text.

    Cutting costs what lies before the cut, so a long list is cut into parts of the text first, and these again.
    """
    if level == 0:
        cut = lambda p: F.concat(F.substring(text, p["start"] - begin + 1, p["end"] - p["start"]), F.lit(mask))
        return F.array_join(F.transform(pieces, cut), "")
    width = BRANCH**level

    def part(i: Column) -> Column:
        def inner(some: Column) -> Column:
            first, last = F.get(some, F.lit(0))["start"], F.element_at(some, -1)["end"]
            return _once(F.substring(text, first - begin + 1, last - first), lambda t: _pieces_of(t, first, some, mask, level - 1))

        return _once(F.slice(pieces, i * width + 1, F.lit(width)), inner)

    places = F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / width).cast("int"))
    return F.when(F.size(pieces) == 0, F.lit("")).otherwise(F.array_join(F.transform(places, part), ""))


def redacted(text: Column, found: Column, mask: str = "[REDACTED]") -> Column:
    """The text with every span, overlapping ones as one, replaced by ``mask``."""
    order = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))

    def cut(rows: Column) -> Column:
        def kept(reach: Column) -> Column:
            before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(reach, i - 1))
            pieces = F.transform(rows, lambda s, i: F.struct(before(i).alias("start"), s["start"].alias("end")))
            pieces = F.filter(pieces, lambda p: p["end"] >= p["start"])
            tail = F.element_at(reach, -1)
            body = _once(pieces, lambda p: _pieces_of(text, F.lit(0), p, mask, LEVELS))
            return F.concat(body, F.substring(text, tail + 1, F.length(text) - tail))

        return _once(_scanned(F.transform(rows, lambda s: s["end"]), lambda a, b: F.greatest(a, b)), kept)

    return F.when(F.size(found) == 0, text).otherwise(_once(order, cut))
