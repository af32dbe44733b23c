"""Secret scanning with a trigram inverted index (DataFrame functions only).

Each rule's regular expression is turned into a Boolean query over trigrams: any text that the
rule matches holds all trigrams of at least one clause. The index lists, per trigram that some
clause names, the documents that hold it; intersecting those lists gives the candidates, which
the regular expression then verifies. A rule without a mandatory trigram scans every text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

# The patterns of the three base rules.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"


@dataclass(frozen=True)
class Rule:
    """``group`` of the match must have at least ``least`` code points; other matches drop out."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE = (Rule("assign", ASSIGN, 2, 8), Rule("access", ACCESS, 0, 16), Rule("hex", HEX, 0, 32))
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{30,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{30,}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
    Rule("urlauth", r"://[A-Za-z0-9._-]{1,64}:[A-Za-z0-9._-]{1,64}@"),
)
RULES = BASE + MORE
_MOST = 64
#: Candidate documents (about 100 bytes each) whose list may be broadcast.
BROADCAST_HITS = 100_000


_QUANTIFIER = re.compile(r"(?:([?*+])|\{(\d+)(?:(,)(\d*))?\})[?+]?")
_OPEN = re.compile(r"\?[a-z-]*:")


def _branches(pattern: str, i: int = 0) -> tuple[list, int]:
    """The alternatives of a pattern from place ``i`` on, and where they end.

    An alternative is a list of (node, least, most times); a node is a set of characters, a list
    of alternatives (a group), or None for anything else, which a query leaves open.
    """

    def escaped(i: int) -> tuple[str | None, int]:
        if pattern[i] == "x":
            return chr(int(pattern[i + 1 : i + 3], 16)), i + 3
        return (None if pattern[i].isalnum() else pattern[i]), i + 1

    def one_of(i: int) -> tuple[set | None, int]:
        chars, known = set(), pattern[i] != "^"
        end = pattern.index("]", i + (1 if known else 2))
        while i < end:
            c, i = escaped(i + 1) if pattern[i] == "\\" else (pattern[i], i + 1)
            known = known and c is not None and not (pattern[i] == "-" and i + 1 < end)
            chars.add(c)
        return (chars if known else None), end + 1

    out: list = [[]]
    while i < len(pattern) and pattern[i] != ")":
        c, i = pattern[i], i + 1
        if c == "|":
            out.append([])
            continue
        if c == "(":
            inner = _OPEN.match(pattern, i)
            node, i = _branches(pattern, inner.end() if inner else i)
            i += 1
        elif c == "[":
            node, i = one_of(i)
        elif c == "\\":
            c, i = escaped(i)
            node = None if c is None else {c}
        else:
            node = None if c in ".^$" else {c}
        least = most = 1
        if times := _QUANTIFIER.match(pattern, i):
            i = times.end()
            least = {"?": 0, "*": 0, "+": 1}.get(times[1], int(times[2] or 0))
            most = {"?": 1, "*": None, "+": None}[times[1]] if times[1] else (int(times[4]) if times[4] else None) if times[3] else least
        out[-1].append((node, least, most))
    return out, i


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Clauses of lower-case trigrams: a match holds every trigram of some clause.

    An empty clause means that no trigram is mandatory. Escapes, classes, groups, alternatives
    and repetitions are read; look-arounds and back-references are not.
    """

    def grams(s: str) -> frozenset[str]:
        return frozenset(s[i : i + 3] for i in range(len(s) - 2))

    def cut(alts):
        return {(have | grams(run), "") for have, run in alts}

    def walk(items, alts):
        for node, least, most in items:
            if isinstance(node, set) and len(node) <= 8 and most == 1:
                with_it = {(have, run + c.lower()) for have, run in alts for c in node}
                alts = with_it if least else alts | with_it
            elif isinstance(node, list) and least == most == 1:
                alts = set().union(*(walk(x, alts) for x in node))
            else:
                alts = cut(alts)
            if len(alts) > _MOST:
                alts = {(frozenset(), "")}
        return alts

    clauses = {have for branch in _branches(pattern)[0] for have, _ in cut(walk(branch, {(frozenset(), "")}))}
    # A clause that holds all of another one adds nothing.
    return sorted((c for c in clauses if not any(d < c for d in clauses)), key=sorted)


def build_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Posting lists (trigram, doc_id) of the trigrams asked for, over whole texts."""
    held = docs.select("doc_id", F.lower("text").alias("_low"))
    found = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return held.select("doc_id", F.explode(found).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """doc_id and the kinds whose trigram query its postings satisfy."""
    rows = [(r.kind, i, t, len(clause)) for r in rules for i, clause in enumerate(trigram_query(r.pattern)) for t in sorted(clause)]
    lit = [F.struct(F.lit(k).alias("kind"), F.lit(i).alias("clause"), F.lit(t).alias("trigram"), F.lit(n).alias("need")) for k, i, t, n in rows]
    clauses = index.sparkSession.range(1).select(F.inline(F.array(*lit)))  # as many rows as the rules have trigrams
    met = index.join(F.broadcast(clauses), "trigram").groupBy("doc_id", "kind", "clause", "need").agg(F.count("*").alias("n"))
    return met.where("n >= need").groupBy("doc_id").agg(F.collect_set("kind").alias("_kinds"))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans of the rule's leftmost non-overlapping matches, in code points.

    Matches and the gaps between them alternate, so their lengths give the offsets.
    """
    length = lambda x: F.char_length(x)
    match = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    kept = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    parts = F.arrays_zip(F.transform(F.split(text, rule.pattern, -1), length).alias("g"), F.transform(match, length).alias("m"), F.transform(kept, length).alias("k"))
    empty = F.array().cast("array<struct<s:int,o:int,e:int,kind:string>>")

    def step(acc, x):
        s = acc["at"] + x["g"]
        e = s + F.coalesce(x["m"], F.lit(0))
        span = F.struct(s.alias("s"), F.lit(order).alias("o"), e.alias("e"), F.lit(rule.kind).alias("kind"))
        return F.struct(e.alias("at"), F.when(x["k"] >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(parts, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, broadcast_hits: int = BROADCAST_HITS) -> DataFrame:
    """doc_id and the sorted array ``found`` of (s, o, e, kind) spans, for every row of ``docs``.

    Null texts count as empty, an empty text has no spans, repeated rows are each reported,
    other columns are ignored. A null doc_id is a document like any other.
    """
    docs = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    indexed = tuple(r for r in rules if frozenset() not in trigram_query(r.pattern))
    trigrams = sorted({t for r in indexed for clause in trigram_query(r.pattern) for t in clause})
    empty = F.array().cast("array<struct<s:int,o:int,e:int,kind:string>>")
    if indexed:
        hits = materialize(candidates(build_index(docs, trigrams), indexed).withColumnRenamed("doc_id", "_id"), "secret-candidates")
        # Few documents are candidates: up to a bound their list goes to the texts, beyond it they meet by a shuffle.
        few = hits.limit(broadcast_hits + 1).count() <= broadcast_hits
        docs = docs.join(F.broadcast(hits) if few else hits, docs["doc_id"].eqNullSafe(F.col("_id")), "left")
    else:
        docs = docs.withColumn("_kinds", F.lit(None).cast("array<string>"))
    parts = [_spans(F.col("text"), r, i) if r not in indexed else F.when(F.array_contains("_kinds", r.kind), _spans(F.col("text"), r, i)).otherwise(empty) for i, r in enumerate(rules)]
    return docs.select("doc_id", F.array_sort(F.concat(*parts)).alias("found"))


def secrets_digest(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    found = scan_secrets(docs)
    n = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("found", lambda x: x["o"] < len(BASE))
    return found.select("doc_id", *[n(r.kind).alias(f"n_{r.kind}") for r in BASE], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))
