"""Personal data: fixed patterns, then bootstrapped contextual extraction.

DataFrame functions only. The fixed patterns give the base spans. The bootstrap
(DIPRE and Basilisk style: Brin 1998; Thelen and Riloff 2002) starts from seed
entities, which are the base spans and public forms of keys, induces lexical patterns
from the words around them and their own first letters, scores the graph of patterns
and instances over the whole corpus until it settles, and lets high-confidence patterns
discover identifiers that no fixed pattern knows. The method's spans are runs that an
accepted pattern has; a seed form alone gives no span.

Defined results: a NULL text has no spans; runs that overlap a base span give no span
of their own; repeated rows get the same spans; an empty table gives an empty result;
other columns are ignored; a text's cost grows with its length and matches, not their square.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import checkpointed, key_text

KINDS = ("email", "ip", "card", "phone", "found")
#: Possessive forms of the patterns of the contract: nothing follows a possessive
#: part that it could give back, so matches are the same and cost is linear.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PARTS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"
#: Identifier-like runs: six characters or more with a digit.
CANDIDATE = r"(?<![A-Za-z0-9_+/@.-])(?=[A-Za-z_+/@.-]*+[0-9])[A-Za-z0-9_+/@.-]{6,}+"
#: Seeds besides the base spans. Public forms of keys and tokens.
SEED_FORMS = (
    r"(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]{32,64}",
    r"(?:AKIA|ASIA)[A-Z0-9]{16}",
    r"gh[pousr]_[A-Za-z0-9]{36}",
    r"AIza[A-Za-z0-9_-]{35}",
    r"xox[abprs]-[A-Za-z0-9-]{10,}",
    r"sk_live_[A-Za-z0-9]{24,}",
)
SEED = "^(?:" + "|".join(SEED_FORMS) + ")$"
CONTEXT_CHARS = 48
#: A pattern needs so many distinct instances, such a share of known ones, and such a product of
#: that share and the logarithm (base 2) of the known ones (Riloff 1996).
MIN_INSTANCES = 3
MIN_SHARE = 1 / 3
MIN_SCORE = 2.0
#: Length from which a run of one class is telling by itself.
LONG = 16
#: Patterns up to which they are broadcast; beyond it both sides are shuffled.
BROADCAST_PATTERNS = 200_000

SPANS = "array<struct<start:int,end:int,value:string,left:string,right:string>>"


def bound(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``, which is worked out once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def running(array: str, step: str) -> str:
    """SQL for the running ``step`` ('{a} + {b}', 'greatest({a}, {b})') of an array.

    Doubles the reach in each of log2(n) turns, since appending to an array inside an
    aggregate copies it and makes long texts quadratic.
    """
    reach = "cast(pow(2, k) as int)"
    both = step.format(a="x", b=f"acc[i - {reach}]")
    turn = f"transform(acc, (x, i) -> if(i < {reach}, x, {both}))"
    return bound(array, "xs", f"aggregate(sequence(0, cast(ceil(log2(greatest(size(xs), 1))) as int)), xs, (acc, k) -> {turn})")


def matches(text: str, pattern: str, guard: str) -> str:
    """SQL for the matches of ``pattern`` as array<struct<start,end,value,left,right>>.

    The texts between matches come from ``split`` and the matches from
    ``regexp_extract_all``; running sums of both give positions in code points.
    ``left`` has the CONTEXT_CHARS characters before, as far as the match before and the
    text around it go, ``right`` the next one. Places are never looked up in the text,
    since that reads it from its start.
    """
    ends = running("transform(f, (v, i) -> length(v) + length(get(g, i)))", "{a} + {b}")
    left = f"lower(right(concat(if(i = 0, '', concat(right(get(g, i - 1), {CONTEXT_CHARS}), get(f, i - 1))), get(g, i)), {CONTEXT_CHARS}))"
    spans = f"transform(f, (v, i) -> named_struct('start', en[i] - length(v), 'end', en[i], 'value', v, 'left', {left}, 'right', left(get(g, i + 1), 1)))"
    found = bound(f"regexp_extract_all({text}, r'{pattern}', 0)", "f", bound(f"split({text}, r'{pattern}', -1)", "g", bound(ends, "en", spans)))
    return f"if({guard}, {found}, cast(array() as {SPANS}))"


LUHN = (
    "aggregate(sequence(1, length(d)), 0, (s, i) -> s + if(i % 2 = 1, cast(substr(d, -i, 1) as int), "
    "element_at(array(0, 2, 4, 6, 8, 1, 3, 5, 7, 9), cast(substr(d, -i, 1) as int) + 1))) % 10 = 0"
)


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``email``, ``ip``, ``card``, ``phone``: arrays of struct(start, end, value, left, right)."""
    t = f"coalesce({text}, '')"
    digits = "regexp_replace(m.value, '[^0-9]', '')"
    card = f"length({digits}) between 14 and 19 and exists(array({digits}), d -> {LUHN})"
    phone = f"length({digits}) between 10 and 15"
    return (
        docs.withColumn("email", F.expr(matches(t, EMAIL, f"contains({t}, '@')")))
        .withColumn("ip", F.expr(f"filter({matches(t, IP, f'{t} rlike r\"[0-9][.][0-9]\"')}, m -> m.value rlike r'{IP_PARTS}')"))
        .withColumn("card", F.expr(f"filter({matches(t, CARD, f'{t} rlike r\"[0-9](?:[ -]?[0-9]){{13}}\"')}, m -> {card})"))
        .withColumn("phone", F.expr(f"filter({matches(t, PHONE, f'contains({t}, \"+\")')}, m -> {phone})"))
    )


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``cand``: base spans and identifier-like runs, each with its lexical patterns.

    ``based`` is 0 for a run that no base span overlaps, 1 for one that a base span
    overlaps, 2 for a base span. Patterns, from the CONTEXT_CHARS characters before, in
    lower case, and the character after: the last three tokens; the last two with the
    class of the run; the last one if it ends with a sign, with the class; an assignment
    or colon with the class, and the first letters with class and length, of long runs.
    """
    t = f"coalesce({text}, '')"
    base = "concat(email, ip, card, phone)"
    none = 2**31 - 1
    # Spans and runs in page order; ends of base spans so far, and starts of base spans to come.
    events = (
        f"array_sort(concat(transform({base}, b -> named_struct('s', b.start, 'c', 0, 'e', b.end, 'v', b.value, 'l', b.left, 'r', b.right)), "
        f"transform({matches(t, CANDIDATE, f'{t} rlike r{chr(34)}[0-9]{chr(34)}')}, c -> named_struct('s', c.start, 'c', 1, 'e', c.end, 'v', c.value, 'l', c.left, 'r', c.right))))"
    )
    before = running("transform(ev, x -> if(x.c = 0, x.e, 0))", "greatest({a}, {b})")
    after = "reverse(" + running(f"transform(reverse(ev), x -> if(x.c = 0, x.s, {none}))", "least({a}, {b})") + ")"
    placed = f"zip_with(ev, zip_with({before}, {after}, (p, q) -> named_struct('p', p, 'q', q)), (x, y) -> named_struct('x', x, 'based', case when x.c = 0 then 2 when y.p > x.s or y.q < x.e then 1 else 0 end))"
    tokens = "slice(reverse(array_remove(split(c.x.l, r'\\s+'), '')), 1, 3)"
    kind = (
        "case when c.x.v rlike '^[0-9]+$' then '9' when c.x.v rlike '^[0-9a-fA-F]+$' then 'f' when c.x.v rlike '^[0-9A-Z]+$' then 'A' "
        "when c.x.v rlike '^[0-9A-Za-z]+$' then 'a' when c.x.v rlike '@' then '@' else '.' end"
    )
    right = "c.x.r"
    sign = "right(regexp_replace(c.x.l, r'[\\s\"\\x27]+$', ''), 1)"
    patterns = (
        "array_compact(array("
        f"if(size(l) > 0, concat_ws('\u0001', '3', array_join(l, ' '), {right}), null), "
        f"if(size(l) > 1, concat_ws('\u0001', '2', l[0], l[1], {right}, {kind}), null), "
        f"if(size(l) > 0 and l[0] rlike r'[^\\p{{L}}\\p{{N}}]$', concat_ws('\u0001', '1', l[0], {right}, {kind}), null), "
        f"if(length(c.x.v) >= {LONG} and {sign} in ('=', ':'), concat_ws('\u0001', '=', {sign}, {kind}), null), "
        f"if(length(c.x.v) >= {LONG} and c.x.v rlike '^[A-Za-z]{{4}}', concat_ws('\u0001', 'p', substr(c.x.v, 1, 4), {kind}, length(c.x.v)), null)))"
    )
    made = f"transform(pl, c -> named_struct('start', c.x.s, 'end', c.x.e, 'value', c.x.v, 'based', c.based, 'patterns', {bound(tokens, 'l', patterns)}))"
    return docs.withColumn("cand", F.expr(bound(events, "ev", bound(placed, "pl", made))))


def _small(patterns: DataFrame) -> DataFrame:
    """``patterns`` with a broadcast hint where a count shows that they are few; staged tables only."""
    return F.broadcast(patterns) if patterns.limit(BROADCAST_PATTERNS + 1).count() <= BROADCAST_PATTERNS else patterns


def bootstrap(edges: DataFrame) -> DataFrame:
    """Accepted patterns: (pattern, confidence), with rounds until no more are accepted.

    ``edges`` has one row per distinct (pattern, instance) with ``seed``. Each round
    scores patterns by the beliefs in their instances and accepts the good ones, then
    instances by the noisy-or of their accepted patterns. Beliefs only rise, so rounds
    end. All steps are keyed aggregates and equi-joins with partial sums.
    """
    common = edges.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_INSTANCES).select("pattern")
    # Staged, so that the join has a shuffle of its own on both sides, which can be split where skewed.
    edges = checkpointed(edges.join(_small(checkpointed(common)), "pattern"))
    known = checkpointed(edges.groupBy("instance").agg(F.max("seed").cast("double").alias("belief")))
    accepted = -1
    while True:
        scored = edges.join(known, "instance").groupBy("pattern").agg(F.count("*").alias("n"), F.sum("belief").alias("f"))
        share = F.col("f") / F.col("n")
        patterns = checkpointed(scored.where((share >= MIN_SHARE) & (F.col("f") > 1)).where(share * F.log2("f") >= MIN_SCORE).select("pattern", share.alias("confidence")))
        count = patterns.count()
        if count == accepted:
            return patterns
        accepted = count
        raised = edges.join(_small(patterns), "pattern").groupBy("instance").agg(F.sum(F.log1p(-F.least("confidence", F.lit(0.999)))).alias("doubt"))
        seeds = edges.groupBy("instance").agg(F.max("seed").cast("double").alias("belief"))
        known = checkpointed(seeds.join(raised, "instance", "left").select("instance", F.greatest("belief", 1.0 - F.exp(F.coalesce("doubt", F.lit(0.0)))).alias("belief")))


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", seed_share: float = 1.0) -> DataFrame:
    """One row a document: key, base span arrays and ``found`` spans of the method.

    ``seed_share`` is the share of seed forms' instances, by hash, that are known from
    the start; under 1 it measures how many of the others the patterns discover.
    """
    narrow = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("_text"))
    row = F.md5(F.concat_ws("\u0001", key_text(F.col("doc_id")), "_text").cast("binary"))
    plain = [F.transform(kind, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"))).alias(kind) for kind in KINDS[:4]]
    read = checkpointed(candidates(base_spans(narrow, "_text"), "_text").select("doc_id", row.alias("row"), *plain, "cand"))
    seed = F.col("c.value").rlike(SEED) & (F.pmod(F.xxhash64("c.value"), F.lit(1000)) < int(1000 * seed_share))
    # The outer form: for the inner one Catalyst adds a filter on the array.
    loose = read.select("row", F.explode_outer("cand").alias("c")).where("c is not null").select(
        "row", "c.start", "c.end", "c.based", "c.patterns", F.lower("c.value").alias("instance"), ((F.col("c.based") > 0) | seed).cast("int").alias("seed")
    )
    edges = loose.select(F.explode("patterns").alias("pattern"), "instance", "seed").groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))
    accepted = bootstrap(checkpointed(edges))
    found = (
        loose.where("based = 0")
        .select("row", "start", "end", F.explode("patterns").alias("pattern"))
        .join(_small(accepted), "pattern")
        .groupBy("row")
        .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("found"))
    )
    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    return read.join(found, "row", "left").select("doc_id", *KINDS[:4], F.coalesce("found", none).alias("found"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` by start, then by kind as listed, comma-joined."""
    return F.concat_ws(",", F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def as_spans(column: str) -> Column:
    kind = KINDS.index(column)
    return F.transform(column, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))
