"""Secret scans: patterns, and sliding-window Shannon entropy over candidate strings.

A candidate is a long run of characters that keys and tokens are written in. A window moves
over it; the counts of its characters, and with them the sum of ``c * log2(c)`` from which
its entropy follows, change by one character in and one out per step. The limit depends on
the window's character class: sixteen digits cannot carry as much as sixty-four. Candidates
on the allow list are passed over, and windows that touch a piece of one, between ``/`` and
``=``, that has a word of the list.

Only DataFrame functions: higher-order functions over the few matches of a text, nothing is
shuffled and nothing leaves the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.tables import read_table

KINDS = ("assign", "access", "hex", "entropy")
# The letters of the names count in either case, ASCII only.
_NAMES = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name)
    for name in ("password", "passwd", "secret", "token", "api_?key")
)
ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A cheap test for texts with an assignment in them.
_MAY_ASSIGN = rf"""({_NAMES})["']?\x20*[:=]"""
ASSIGN_LEAST = 6
# Runs are taken whole, so the least length may stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
# Bits per character from which a window counts, by the class of its characters: digits
# only; hexadecimal; digits and letters of one case; anything else.
LIMITS = {"digits": 3.0, "hex": 3.0, "case": 3.9, "mixed": 3.9}
# The same so that of random keys of 32 characters, written in 10, 16, 32 or 64 characters,
# one in twenty at most has no window that counts.
CLASS_LIMITS = {"digits": 2.84, "hex": 3.0, "case": 3.68, "mixed": 3.9}
# Candidates that are known not to be secrets: without a digit or without a letter.
ALLOWED_RUNS = (r"^[^0-9]*$", r"^[^A-Za-z]*$")
# Words of a place holder, and the alphabet or the digits in order.
ALLOWED_WORDS = (
    r"[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Pp]laceholder|[Cc]hangeme|[Xx]{6}",
    r"[Aa][Bb][Cc][Dd][Ee][Ff][Gg][Hh]|01234567",
)
ALLOWED = (*ALLOWED_RUNS, *ALLOWED_WORDS)
# Lists grow by copying; in blocks of so many, a long list stays cheap to build.
_BLOCK = 256
_FIRST, _LAST = ord("+"), ord("z")

# Characters of a window that are counted by class; the others are not hexadecimal.
_CLASSES = ("digits", "lower", "upper", "symbols", "others")

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _most(bits: float) -> float:
    """The sum of c * log2(c) at which a window has so many bits."""
    return round(WINDOW * (math.log2(WINDOW) - bits), 6)


def _bound(value: Column, use: Callable) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _in_blocks(items: Column, state: Column, step: Callable, out: str) -> Column:
    """``aggregate`` of ``step`` over ``items``, whose list ``out`` in the state is put
    together from blocks. ``state``: a struct with an empty ``out``."""
    blocks = _bound(
        items,
        lambda all_items: F.transform(
            F.sequence(F.lit(0), F.floor((F.size(all_items) - 1) / _BLOCK).cast("int")),
            lambda k: F.slice(all_items, k * _BLOCK + 1, _BLOCK),
        ),
    )
    empty = F.array().cast(_SPAN)

    def block(held: Column, chunk: Column) -> Column:
        return _bound(
            F.aggregate(chunk, held["state"], step),
            lambda done: F.struct(
                done.withField(out, empty).alias("state"),
                F.concat(held["lists"], F.array(done[out])).alias("lists"),
            ),
        )

    start = F.struct(state.alias("state"), F.array().cast(f"array<{_SPAN}>").alias("lists"))
    return F.aggregate(
        blocks, start, block, lambda held: held["state"].withField(out, F.flatten(held["lists"]))
    )


def _matches(text: Column, pattern: str, group: int) -> Column:
    """For each match what stands before it, the match, and a group of it. The last item,
    behind the last match, has no match."""
    return F.arrays_zip(
        F.split(text, pattern).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"),
    )


def _located(
    text: Column, guard: str, pattern: str, group: int, found: Callable
) -> Column:
    """The spans of the matches that ``found(part)`` lets through, or that it makes."""

    def step(state: Column, item: Column) -> Column:
        gap, match, part = item["gap"], item["match"], item["part"]
        start = state["at"] + F.length(gap)
        spans = F.when(match.isNotNull(), found(part, start, start + F.length(match)))
        return F.struct(
            (start + F.coalesce(F.length(match), F.lit(0))).alias("at"),
            F.concat(state["spans"], F.coalesce(spans, F.array().cast(_SPAN))).alias("spans"),
        )

    empty = F.array().cast(_SPAN)
    state = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    spans = _in_blocks(_matches(text, pattern, group), state, step, "spans")["spans"]
    return F.when(text.rlike(guard), spans).otherwise(empty)


def _one(kind: int, least: int = 0) -> Callable:
    def found(part: Column, start: Column, end: Column) -> Column:
        span = F.array(
            F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        ).cast(_SPAN)
        return F.when(F.length(part) >= least, span)

    return found


def _any(text: Column, patterns: Sequence[str]) -> Column:
    found = F.lit(False)
    for pattern in patterns:
        found = found | text.rlike(pattern)
    return found


def _barred(part: Column, words: Sequence[str]) -> Column:
    """For each character of a candidate, whether it is in a piece with one of the words."""
    pieces = F.transform(
        F.split(part, "(?<=[/=])"), lambda p: F.array_repeat(_any(p, words), F.length(p))
    )
    return F.when(_any(part, words), F.flatten(pieces)).otherwise(
        F.array_repeat(F.lit(False), F.length(part))
    )


def _entropic(allowed: Sequence[str], limits: Mapping[str, float], words: Sequence[str]) -> Callable:
    """The maximal stretches of a candidate under windows with enough entropy."""
    weights = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)])
    zeros = F.array_repeat(F.lit(0), _LAST - _FIRST + 1)
    empty = F.array().cast(_SPAN)
    kind = KINDS.index("entropy")

    def span(begin: Column, end: Column) -> Column:
        one = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        return F.array(one).cast(_SPAN)

    def found(part: Column, start: Column, end: Column) -> Column:
        codes = F.transform(F.split(part, ""), lambda c: F.ascii(c) - _FIRST)
        # Each step's character in and character out; none goes out of the first window.
        none = F.array_repeat(F.lit(-1), WINDOW)
        steps = F.arrays_zip(
            codes.alias("enters"),
            F.concat(none, codes).alias("leaves"),
            _barred(part, words).alias("barred"),
        )
        steps = F.slice(steps, 1, F.length(part))

        def classes(code: Column) -> dict[str, Column]:
            """Of a character: is it one of these? None goes out as none of them."""
            c = code + _FIRST
            lower, upper, digit = c.between(97, 122), c.between(65, 90), c.between(48, 57)
            hexed = digit | c.between(97, 102) | c.between(65, 70)
            return {
                "digits": digit,
                "lower": lower,
                "upper": upper,
                "symbols": (code >= 0) & ~(lower | upper | digit),
                "others": (code >= 0) & ~hexed,
            }

        def counted(state: Column, enters: Column, leaves: Column) -> list[Column]:
            come, go = classes(enters), classes(leaves)
            return [
                (state[name] + come[name].cast("int") - go[name].cast("int")).alias(name)
                for name in come
            ]

        def weight(count: Column) -> Column:
            return F.element_at(weights, count + 1)

        def step(state: Column, item: Column) -> Column:
            enters, leaves = item["enters"], item["leaves"]
            more = F.element_at(state["counts"], enters + 1)
            # The character that goes is counted after the one that comes is in.
            fewer = F.element_at(state["counts"], leaves + 1) + (enters == leaves).cast("int")
            lost = F.when(leaves >= 0, weight(fewer) - weight(fewer - 1)).otherwise(0.0)
            counts = F.transform(
                state["counts"],
                lambda c, j: c + (j == enters).cast("int") - (j == leaves).cast("int"),
            )
            moved = F.struct(
                (state["total"] + weight(more + 1) - weight(more) - lost).alias("total"),
                *counted(state, enters, leaves),
                F.when(item["barred"], state["place"] + 1).otherwise(state["bar"]).alias("bar"),
            )
            return _bound(moved, lambda now: judged(state, counts, now))

        def judged(state: Column, counts: Column, now: Column) -> Column:
            one_case = (now["lower"] == 0) | (now["upper"] == 0)
            limit = (
                F.when(now["digits"] == WINDOW, _most(limits["digits"]))
                .when(now["others"] == 0, _most(limits["hex"]))
                .when((now["symbols"] == 0) & (now["digits"] > 0) & one_case, _most(limits["case"]))
                .otherwise(_most(limits["mixed"]))
            )
            place = state["place"] + 1
            hot = (place >= WINDOW) & (now["total"] <= limit) & (place - now["bar"] >= WINDOW)
            begin, close = start + place - WINDOW, start + place
            apart = hot & (begin > state["close"])
            flush = apart & (state["close"] > state["open"])
            return F.struct(
                counts.alias("counts"),
                *[now[name].alias(name) for name in ("total", *_CLASSES, "bar")],
                place.alias("place"),
                F.when(apart, begin).otherwise(state["open"]).alias("open"),
                F.when(hot, close).otherwise(state["close"]).alias("close"),
                F.when(flush, F.concat(state["spans"], span(state["open"], state["close"])))
                .otherwise(state["spans"])
                .alias("spans"),
            )

        state = F.struct(
            zeros.alias("counts"),
            F.lit(0.0).alias("total"),
            *[F.lit(0).alias(name) for name in _CLASSES],
            F.lit(-WINDOW).alias("bar"),
            F.lit(0).alias("place"),
            F.lit(-1).alias("open"),
            F.lit(-1).alias("close"),
            empty.alias("spans"),
        )
        spans = _bound(
            _in_blocks(steps, state, step, "spans"),
            lambda done: F.concat(
                done["spans"],
                F.when(done["close"] > done["open"], span(done["open"], done["close"])).otherwise(
                    empty
                ),
            ),
        )
        return F.when(~_any(part, allowed), spans)

    return found


def scan_secrets(
    docs: DataFrame,
    allowed: Sequence[str] = ALLOWED,
    limits: Mapping[str, float] = LIMITS,
    words: Sequence[str] = (),
) -> DataFrame:
    """All rows and columns of ``docs``, with ``spans``: an array of ``start, kind, end``,
    by start and kind (places in ``KINDS``). Offsets are code points of ``text``, ends
    exclusive. A column ``spans`` is replaced.

    The patterns' matches are leftmost and do not overlap within a kind; an assignment
    counts if its value has 6 characters or more, and its span is the whole match. Entropy
    spans are the union of the windows that reach their limit, and may overlap with the
    others. ``allowed`` suppresses the entropy spans of a whole candidate, ``words`` those
    windows that touch a piece with one of them. Null and empty texts have no spans; rows
    may repeat.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    spans = F.concat(
        _located(text, _MAY_ASSIGN, ASSIGN, 2, _one(0, ASSIGN_LEAST)),
        _located(text, ACCESS, ACCESS, 0, _one(1)),
        _located(text, HEX, HEX, 0, _one(2)),
        _located(text, CANDIDATE, CANDIDATE, 0, _entropic(allowed, limits, words)),
    )
    return docs.withColumn("spans", F.array_sort(spans))


def spans_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    written = F.transform(
        spans,
        lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]),
    )
    return F.array_join(written, ",")


def op6_scan_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = scan_secrets(documents, ALLOWED_RUNS, CLASS_LIMITS, ALLOWED_WORDS)
    scanned = scanned.select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["kind"] < KINDS.index("entropy"))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _sql_matches(kind: int, pattern: str, group: int) -> str:
    return f"""
  select doc_id, {kind} as kind, string_split_regex(text, {_quoted(pattern)}) as gaps,
         regexp_extract_all(text, {_quoted(pattern)}, 0) as matches,
         regexp_extract_all(text, {_quoted(pattern)}, {group}) as parts
  from texts"""


SQL = f"""
with texts as (
  select doc_id, coalesce(text, '') as text from documents
), listed as ({" union all ".join([
    _sql_matches(0, ASSIGN, 2), _sql_matches(1, ACCESS, 0),
    _sql_matches(2, HEX, 0), _sql_matches(3, CANDIDATE, 0)])}
), each_match as (
  select doc_id, kind, unnest(gaps[: len(matches)]) as gap, unnest(matches) as match,
         unnest(parts) as part, generate_subscripts(matches, 1) as turn
  from listed
), located as (
  select doc_id, kind, part, length(match) as size,
         (sum(length(gap) + length(match)) over (partition by doc_id, kind order by turn))::int
           as stop
  from each_match
), candidates as (
  select doc_id, part, stop - size as start, row_number() over () as candidate
  from located where kind = 3 and not ({" or ".join(
      f"regexp_matches(part, {_quoted(p)})" for p in ALLOWED_RUNS)})
), pieces as (
  select doc_id, candidate, start, text,
         sum(length(text) + 1) over (partition by candidate order by turn) - length(text) - 1
           as low
  from (select doc_id, candidate, start, unnest(string_split_regex(part, '[/=]')) as text,
               generate_subscripts(string_split_regex(part, '[/=]'), 1) as turn
        from candidates)
), barred as (
  select candidate, start + low as low, start + low + length(text) + 1 as high
  from pieces where {" or ".join(f"regexp_matches(text, {_quoted(p)})" for p in ALLOWED_WORDS)}
), windows as (
  select doc_id, candidate, start + i as begin,
         substring(part, i + 1, {WINDOW}) as piece
  from (select *, unnest(range(0, length(part) - {WINDOW} + 1))::int as i from candidates) c
  where not exists (select 1 from barred b where b.candidate = c.candidate
                    and c.start + c.i < b.high and c.start + c.i + {WINDOW} > b.low)
), counted as (
  select doc_id, candidate, begin, piece, letter, count(*) as c
  from (select *, unnest(string_split(piece, '')) as letter from windows) group by all
), hot as (
  select doc_id, candidate, begin from counted
  group by doc_id, candidate, begin, piece
  having sum(c * log2(c)) <= case
    when regexp_full_match(piece, '[0-9]*') then {_most(CLASS_LIMITS["digits"])}
    when regexp_full_match(piece, '[0-9A-Fa-f]*') then {_most(CLASS_LIMITS["hex"])}
    when regexp_full_match(piece, '[0-9a-z]*|[0-9A-Z]*') and regexp_matches(piece, '[0-9]')
      then {_most(CLASS_LIMITS["case"])}
    else {_most(CLASS_LIMITS["mixed"])} end
), islands as (
  select *, sum(fresh) over (partition by candidate order by begin) as island
  from (select *, case when begin > lag(begin) over (partition by candidate order by begin)
          + {WINDOW} then 1 else 0 end as fresh from hot)
), spans as (
  select doc_id, kind, stop - size as start, stop from located
  where kind in (1, 2) or kind = 0 and length(part) >= {ASSIGN_LEAST}
  union all
  select doc_id, 3, min(begin), max(begin) + {WINDOW} from islands
  group by doc_id, candidate, island
), written as (
  select *, {list(KINDS)}[kind + 1] || ':' || start || ':' || stop as line from spans
), joined as (
  select doc_id, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access,
         count(*) filter (kind = 2) as n_hex,
         string_agg(line, ',' order by start, kind) filter (kind < 3) as base,
         string_agg(line, ',' order by start, kind, stop) as spans
  from written group by doc_id
)
select doc_id, coalesce(n_assign, 0)::bigint as n_assign,
       coalesce(n_access, 0)::bigint as n_access, coalesce(n_hex, 0)::bigint as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents left join joined using (doc_id)
"""
