"""Secret scans through a trigram inverted index (native DataFrame functions only).

From each rule's regular expression a Boolean query over trigrams is derived:
every text that matches must satisfy it. The index lists, for each trigram that
some query names, the documents whose lower-cased text holds it (postings).
Intersecting and uniting postings as the queries say leaves each rule's
candidates, and only candidates are searched with the expression itself. A rule
without mandatory trigrams scans every text.

Spans are found by marking all matches at once with ``regexp_replace`` and
adding up the lengths of the parts between the marks; the mark is a control
character that no rule can match.

Edge cases: a null text is empty and has no spans; repeated rows and null ids
are scanned each on their own; an empty table gives an empty result. Whole texts are
searched, however long. Extra columns pass through ``scan`` untouched.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casestar.llm.common import fresh, let

MARK, STAND_IN = "\x01", "\x02"


@dataclass(frozen=True)
class Rule:
    """``group`` must have ``least`` characters, else the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def shortest(self) -> str | None:
        """The same rule with the length in the expression, where that changes no match."""
        m = re.fullmatch(r"((?:[A-Za-z]*))(\[[^\]]+\])\+", self.pattern)
        return f"{m[1]}{m[2]}{{{self.least - len(m[1])},}}" if m and not self.group else None


#: The three base kinds, then the kinds that the method adds.
RULES = (
    Rule("assign", r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,255}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,250}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("stripe", r"[sr]k_live_[0-9A-Za-z]{16,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
)

# A Boolean query in disjunctive form: sets of trigrams, one of which a text
# must hold in full. ANY (one empty set) asks for nothing.
Query = frozenset[frozenset[str]]
ANY: Query = frozenset([frozenset()])
MOST_STRINGS = 64   # a list of possible strings is cut into trigrams beyond that


def trigram_query(pattern: str) -> Query:
    """Trigrams that every text matching ``pattern`` holds, in lower case."""
    return _simplify(_query(list(parser.parse(pattern))))


def _simplify(q: Query) -> Query:
    return frozenset(a for a in q if not any(b < a for b in q))


def _and(a: Query, b: Query) -> Query:
    return _simplify(frozenset(x | y for x in a for y in b))


def _grams(strings: set[str]) -> Query:
    """One of the strings occurs: the trigrams of one of them."""
    return _simplify(frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings))


def _strings(node) -> set[str] | None:
    """All texts that a node can match (lower case), if they are few."""
    kind, arg = node
    if kind is op.LITERAL:
        return {chr(arg).lower()}
    if kind is op.IN:
        if any(k is not op.LITERAL for k, _ in arg):
            return None
        return {chr(v).lower() for _, v in arg}
    if kind is op.SUBPATTERN:
        return _sequence(arg[3])
    if kind is op.BRANCH:
        alts = [_sequence(a) for a in arg[1]]
        return None if None in alts else set().union(*alts)
    if kind is op.MAX_REPEAT and arg[1] is not op.MAXREPEAT and arg[1] <= 3:
        one = _sequence(arg[2])
        if one is None:
            return None
        out, power = set(), {""}
        for n in range(int(arg[1]) + 1):
            out |= power if n >= arg[0] else set()
            power = {a + b for a in power for b in one}
        return out if len(out) <= MOST_STRINGS else None
    return None


def _sequence(nodes) -> set[str] | None:
    out = {""}
    for node in nodes:
        one = _strings(node)
        if one is None or len(out) * len(one) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in one}
    return out


def _query(nodes) -> Query:
    """Runs of nodes with few possible texts give trigrams; others are asked themselves."""
    found, run = ANY, {""}
    for node in [*nodes, None]:
        one = _strings(node) if node is not None else None
        if one is not None and len(run) * len(one) <= MOST_STRINGS:
            run = {a + b for a in run for b in one}
            continue
        found = _and(found, _grams(run))
        run = one if one is not None else {""}
        if node is not None and one is None:
            found = _and(found, _inner(node))
    return found


def _inner(node) -> Query:
    kind, arg = node
    if kind is op.SUBPATTERN:
        return _query(list(arg[3]))
    if kind is op.BRANCH:
        return _simplify(frozenset().union(*(_query(list(a)) for a in arg[1])))
    if kind is op.MAX_REPEAT and arg[0] >= 1:
        return _query(list(arg[2]))
    return ANY


def build_index(df: DataFrame, grams: list[str], key: str, text: str) -> DataFrame:
    """Postings (gram, key): which rows hold which of the trigrams asked for."""
    low = fresh(df, "low")
    held = F.filter(F.array(*[F.lit(g) for g in grams]), lambda g: F.contains(F.col(low), g))
    return df.select(key, F.lower(F.coalesce(F.col(text), F.lit(""))).alias(low)).select(
        F.col(key), F.explode(held).alias("gram")).distinct()


def candidates(index: DataFrame, queries: dict[str, Query], key: str) -> DataFrame:
    """(key, kinds): the rules whose query a row's postings satisfy. Each clause
    intersects its postings by counting; a key has a posting per trigram at most."""
    clauses = [(kind, f"{kind}/{i}", sorted(c)) for kind, q in queries.items() for i, c in enumerate(
        sorted(q, key=sorted))]
    by_gram: dict[str, list[str]] = {}
    for _, name, grams in clauses:
        for g in grams:
            by_gram.setdefault(g, []).append(name)
    of_gram = F.create_map(*[x for g, names in sorted(by_gram.items()) for x in (
        F.lit(g), F.array(*map(F.lit, names)))])
    need = F.create_map(*[x for kind, name, grams in clauses for x in (
        F.lit(name), F.struct(F.lit(kind).alias("kind"), F.lit(len(grams)).alias("n")))])
    hits = index.select(key, F.explode(F.element_at(of_gram, F.col("gram"))).alias("clause"))
    met = hits.groupBy(key, "clause").agg(F.count("*").alias("n"))
    met = met.withColumn("need", F.element_at(need, F.col("clause"))).filter("n = need.n")
    return met.groupBy(key).agg(F.collect_set("need.kind").alias("kinds"))


def spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, order, end, kind) of the rule's matches, in code points."""
    clean = F.translate(text, MARK, STAND_IN)
    if rule.group:      # the group ends the match: mark its start too
        groups = re.compile(rule.pattern).groups
        head, tail = rule.pattern.split("(" * 1 + rule.pattern.rsplit("(", 1)[1])[0], rule.pattern.rsplit("(", 1)[1]
        marked = F.regexp_replace(clean, F.lit(f"({head})({tail}"), F.lit(f"{MARK}$1{MARK}$2{MARK}"))
        parts, every = F.split(marked, MARK), 3
        assert groups == rule.group == 1
    else:
        marked = F.regexp_replace(clean, F.lit(f"({rule.shortest or rule.pattern})"), F.lit(f"{MARK}$1{MARK}"))
        parts, every = F.split(marked, MARK), 2

    def step(a: Column, p: Column) -> Column:
        n = F.length(p)
        ends = a["i"] % every == every - 1
        enough = ends & (n >= rule.least)
        start = a["from"] if every == 3 else a["at"]
        found = F.struct(start.alias("start"), F.lit(order).alias("order"), (a["at"] + n).alias("end"),
                         F.lit(rule.kind).alias("kind"))
        return F.struct((a["i"] + 1).alias("i"), (a["at"] + n).alias("at"),
                        F.when(a["i"] % every == 1, a["at"]).otherwise(a["from"]).alias("from"),
                        F.when(enough, F.concat(a["out"], F.array(found))).otherwise(a["out"]).alias("out"))

    zero = F.struct(F.lit(0).alias("i"), F.lit(0).alias("at"), F.lit(0).alias("from"), no_spans().alias("out"))
    return F.aggregate(parts, zero, step, lambda a: a["out"])


def no_spans() -> Column:
    return F.from_json(F.lit("[]"), "array<struct<start int, order int, end int, kind string>>")


def scan(df: DataFrame, text: str = "text", key: str = "doc_id", out: str = "spans",
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with all rules' spans in array ``out``, by start, then rule order."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    asked = {k: q for k, q in queries.items() if q != ANY}
    row, kinds = fresh(df, "row"), fresh(df, "kinds")
    keyed = df.withColumn(row, F.xxhash64(key, text))
    grams = sorted({g for q in asked.values() for c in q for g in c})
    found = candidates(build_index(keyed, grams, row, text), asked, row).withColumnRenamed("kinds", kinds)
    joined = keyed.join(found, row, "left")
    t = F.coalesce(F.col(text), F.lit(""))

    def one(rule: Rule, order: int) -> Column:
        found = spans(t, rule, order)
        if rule.kind in asked:
            return F.when(F.array_contains(F.col(kinds), rule.kind), found).otherwise(no_spans())
        first = rule.shortest or rule.pattern
        return F.when(t.rlike(first), found).otherwise(no_spans())

    ordered = F.array_sort(F.concat(*[one(r, i) for i, r in enumerate(rules)]))
    return joined.withColumn(out, ordered).drop(row, kinds)


def joined_spans(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """Per document: counts and digest of the base kinds, and all spans."""
    scanned = scan(docs.select("doc_id", "text"), out="__spans")
    s = F.col("__spans")

    def count(kind: str) -> Column:
        return F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(s, lambda x: x["order"] < 3)
    return scanned.select("doc_id", count("assign"), count("access"), count("hex"),
                          F.sha2(joined_spans(base).cast("binary"), 256).alias("base_sha256"),
                          joined_spans(s).alias("spans"))
