"""Secrets in documents: trigram postings choose candidates, the rules' patterns verify them."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from itertools import product
from re import _constants as ops
from re import _parser as parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from resolvscope.llm.text import digest

# Largest set of alternatives that is kept as whole strings while a pattern is read.
ALTERNATIVES = 32


@dataclass(frozen=True)
class Rule:
    """A pattern without look-around and back references. ``value`` must be at least ``least`` characters of group ``group``."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


# The rules that always count.
BASE_RULES = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]+", 0, 24, True),
]
# Published forms of well-known credentials.
MORE_RULES = [
    Rule("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"sk_live_[0-9a-zA-Z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", r"(?i:authorization): ?(?i:bearer) ([A-Za-z0-9._~+/=-]+)", 1, 8),
]


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """What a lower-cased text must contain for the pattern to match, as AND of OR of trigram sets; empty: no condition.

    Runs of literals are kept as a set of possible strings (alternatives and optional parts multiply it). At each part that
    is no literal the run ends; every string of a run of three characters or more gives a set of trigrams that all occur.
    """

    def close(run: set[str], query: list) -> None:
        if run and min(map(len, run)) >= 3:
            branches = {_trigrams(s) for s in run}
            # A branch that asks for more than another one adds nothing.
            query.append(sorted((b for b in branches if not any(o < b for o in branches)), key=sorted))

    def strings(items) -> set[str] | None:
        """All strings of a short literal part, or None."""
        run = {""}
        for op, value in items:
            if op is ops.LITERAL:
                more = {chr(value).lower()}
            elif op is ops.SUBPATTERN:
                more = strings(value[3])
            elif op is ops.BRANCH:
                parts = [strings(x) for x in value[1]]
                more = None if None in parts else set().union(*parts)
            elif op is ops.MAX_REPEAT and value[1] == 1:
                inner = strings(value[2])
                more = None if inner is None else inner | ({""} if value[0] == 0 else set())
            elif op is ops.IN and len(value) <= 8 and all(x is ops.LITERAL for x, _ in value):
                more = {chr(x).lower() for _, x in value}
            else:
                return None
            if more is None or len(run) * len(more) > ALTERNATIVES:
                return None
            run = {a + b for a, b in product(run, more)}
        return run

    def read(items, query: list) -> None:
        run: set[str] = {""}
        for item in items:
            op, value = item
            more = strings([item])
            if more is not None and len(run) * len(more) <= ALTERNATIVES:
                run = {a + b for a, b in product(run, more)}
                continue
            close(run, query)
            run = {""} if more is None else more
            if op is ops.SUBPATTERN:
                read(value[3], query)
            elif op is ops.MAX_REPEAT and value[0] >= 1:
                read(value[2], query)
        close(run, query)

    query: list[list[frozenset[str]]] = []
    read(parser.parse(pattern), query)
    return query


def _queries(rules: list[Rule]) -> tuple[dict[str, list], list[str], list[str]]:
    """Trigram query of each rule that has one, the kinds that scan all texts, and all trigrams asked for."""
    asked = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    full = [r.kind for r in rules if r.kind not in asked]
    return asked, full, sorted({t for q in asked.values() for clause in q for grams in clause for t in grams})


def postings(documents: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Inverted index (gram, doc_id, digest), a row for each asked trigram that a lower-cased text contains."""
    text = F.lower(F.coalesce("text", F.lit("")))
    return (
        documents.select("doc_id", digest(F.col("text")).alias("digest"), text.alias("lowered"))
        .select("doc_id", "digest", F.array(*[F.when(F.contains("lowered", F.lit(g)), F.lit(i)) for i, g in enumerate(vocabulary)]).alias("grams"))
        .select("doc_id", "digest", F.explode(F.array_compact("grams")).alias("gram"))
    )


def _plan(spark: SparkSession, asked: dict[str, list], vocabulary: list[str]) -> DataFrame:
    """The queries as rows (gram, kind, clause, branch, needed): all grams of one branch of every clause are needed."""
    place = {g: i for i, g in enumerate(vocabulary)}
    rows = [
        F.struct(*[F.lit(v).alias(n) for n, v in zip(("gram", "kind", "clauses", "clause", "branch", "needed"), row, strict=True)])
        for kind, query in asked.items()
        for c, clause in enumerate(query)
        for b, grams in enumerate(clause)
        for g in sorted(grams)
        for row in [(place[g], kind, len(query), c, b, len(grams))]
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def candidates(documents: DataFrame, rules: list[Rule]) -> DataFrame:
    """(doc_id, digest, kinds): the rules whose trigram query a document's postings meet."""
    asked, _, vocabulary = _queries(rules)
    key = ["doc_id", "digest"]
    return (
        postings(documents, vocabulary)
        .join(F.broadcast(_plan(documents.sparkSession, asked, vocabulary)), "gram")
        .groupBy(*key)
        # A document's postings among the asked trigrams are few; the set also drops repeated rows.
        .agg(F.collect_set(F.struct("kind", "clauses", "clause", "branch", "needed", "gram")).alias("met"))
        .select(*key, F.explode("met").alias("m"))
        .select(*key, "m.*")
        .groupBy(*key, "kind", "clauses", "clause", "branch", "needed")
        .agg(F.count("gram").alias("n"))
        .where(F.col("n") == F.col("needed"))
        .groupBy(*key, "kind", "clauses")
        .agg(F.countDistinct("clause").alias("n"))
        .where(F.col("n") == F.col("clauses"))
        .groupBy(*key)
        .agg(F.collect_set("kind").alias("kinds"))
    )


def _spans(rule: Rule, text: Column) -> Column:
    """Matches of a rule as (start, order, kind, end), leftmost first, in code points, those that fail left out."""
    pattern = _verified(rule)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group)) if rule.group else whole
    between = F.split(text, pattern, -1)
    pieces = F.arrays_zip(F.slice(between, 1, F.size(whole)).alias("gap"), whole.alias("whole"), value.alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("found"))
    return F.aggregate(
        pieces,
        start,
        lambda done, p: F.struct(
            (done["at"] + F.length(p["gap"]) + F.length(p["whole"])).alias("at"),
            # Failing matches are passed over, so that the list stays short.
            F.when(F.length(p["value"]) < rule.least, done["found"])
            .otherwise(
                F.concat(
                    done["found"],
                    F.array(
                        F.struct(
                            (done["at"] + F.length(p["gap"])).alias("start"),
                            (done["at"] + F.length(p["gap"]) + F.length(p["whole"])).alias("end"),
                        )
                    ),
                )
            )
            .alias("found"),
        ),
        lambda done: done["found"],
    )


def _named(place: int, kind: str) -> Callable[[Column], Column]:
    return lambda s: F.struct(s["start"].alias("start"), F.lit(place).alias("place"), F.lit(kind).alias("kind"), s["end"].alias("end"))


def _of_kind(kinds: list[str]) -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(kinds))


def _verified(rule: Rule) -> str:
    """The pattern to verify with. Runs of one class are maximal, so their least length can stand in the pattern itself."""
    if rule.group == 0 and rule.least and re.fullmatch(r"\[[^\]]+\]\+", rule.pattern):
        return f"{rule.pattern[:-1]}{{{rule.least},}}"
    return rule.pattern


def scan(documents: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """``doc_id`` and ``spans`` of each row: an array of (start, place, kind, end), sorted, ends exclusive, in code points.

    A Boolean trigram query is derived from each rule's pattern. Postings of the asked trigrams are built over the
    lower-cased texts, met branch by branch and clause by clause with counts, and give candidates (document, rule).
    Candidates are joined back to the texts, where the pattern decides; a rule without mandatory trigrams tries all texts.
    Matches of a kind are leftmost and do not overlap; one whose value is too short is consumed, then left out.

    Null and empty texts have no spans. Rows with a null id are told apart by their text, repeated rows all get the spans.
    Columns other than ``doc_id`` and ``text`` are ignored. A run of many thousand matches in one text is walked in that
    row; nothing is cut.
    """
    rules = BASE_RULES + MORE_RULES if rules is None else rules
    asked, full, _ = _queries(rules)
    left = documents.select("doc_id", digest(F.col("text")).alias("digest"), F.coalesce("text", F.lit("")).alias("text"))
    if asked:
        right = candidates(documents, rules).select(F.col("doc_id").alias("c_id"), F.col("digest").alias("c_digest"), "kinds")
        left = left.join(right, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("digest") == F.col("c_digest")), "left")
    else:
        left = left.withColumn("kinds", F.lit(None).cast("array<string>"))
    # The text a rule verifies, null where the rule is no candidate or the text holds no match that could pass.
    tried = [
        F.when((F.lit(True) if r.kind in full else F.array_contains("kinds", r.kind)) & F.col("text").rlike(_verified(r)), F.col("text")) for r in rules
    ]
    found = left.select("doc_id", *[t.alias(f"text_{i}") for i, t in enumerate(tried)])
    none = F.array().cast("array<struct<start:int,place:int,kind:string,end:int>>")
    spans = [F.coalesce(F.transform(_spans(r, F.col(f"text_{i}")), _named(i, r.kind)), none) for i, r in enumerate(rules)]
    return found.select("doc_id", F.sort_array(F.concat(*spans)).alias("spans"))


def summarise(found: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Counts and digests of ``scan``'s rows."""
    rules = BASE_RULES + MORE_RULES if rules is None else rules
    base = [r.kind for r in rules if r.base]
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id",
        *[F.size(_of_kind([k])).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(joined(_of_kind(base)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
