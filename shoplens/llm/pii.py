"""PII spans by weak supervision (DataFrame and SQL functions only).

Candidates: the four base patterns, plus looser forms of each kind (obfuscated
mail addresses, national phone numbers, bracketed IPs, cards grouped by dots).
Five labelers vote on each candidate: strict pattern, gazetteer (mail domains,
calling codes, issuer prefixes, routable octets), cue words in the left context,
clean borders, and a format check. Expectation-maximisation over the table of
vote patterns (its size is fixed by the number of labelers) estimates each
labeler's reliability and the patterns' posteriors; a logistic span classifier is
then trained on them. Base spans always stay; a looser candidate is added when
the classifier gives it at least ``threshold``.

Regular expressions are written with possessive repeats that start at the
beginning of a run, so very long texts are read in linear time and without deep
recursion; what they match is what the plain patterns match.

Places are code points. Matches are marked by U+0001, in a text that holds that
character by U+0002 around more of them in a row than the text has, so every text is
read and, but for its spans, kept as it is. Spans are placed block by block, so that
the work grows with the text and not with the square of its matches. Defined results: null and empty texts have no spans;
repeated rows give repeated results; a table without candidates adds nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import named, stored

LOCAL, LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"
BLOCK = 256      # matches placed together


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    valid: str       # SQL over the match {m}
    needs: str       # a text without a match of this has no base candidate
    loose: str
    loose_needs: str
    gazetteer: str   # regular expression on the candidate
    cues: str        # regular expression on the lower-cased left context
    form: str        # SQL over {m}: format check


DIGITS = "regexp_replace({m}, '[^0-9]', '')"
#: Contract order. Gazetteers and cue words are fixed values.
KINDS = (
    Kind("email", rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[{LABEL}]++(?:\.[{LABEL}]++)++", "true", "@",
         rf"(?<![{LOCAL}])[{LOCAL}]++ ?(?:\(at\)|\[at\]) ?[{LABEL}]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[{LABEL}]++)++",
         r"[(\[]at[)\]]",
         r"(?i)(?:com|org|net|edu|gov|io|info|de|fr|es|uk|eu)$",
         r"mail|contact|write|kontakt|schreib|correo|courriel|écri|escrib",
         "length({m}) between 6 and 254"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         r"forall(split({m}, '[.]'), p -> coalesce(try_cast(regexp_extract(p, '^0*([0-9]{{0,4}})$', 1) as int), if(p rlike '^0+$', 0, 999)) <= 255)",
         "[0-9]",
         r"(?<![0-9])[0-9]{1,3}(?:(?:\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])", r"[(\[]\.[)\]]",
         r"^(?!0|10\D|127\D|255\D)[0-9]{1,3}",
         r"\bip\b|server|host|login|adresse|address|dirección|client",
         r"not {m} rlike '(^|[.])0[0-9]'"),
    Kind("card", r"[0-9](?:[ -]?[0-9])++",
         "luhn_check(regexp_replace({m}, '[ -]', '')) and length(regexp_replace({m}, '[ -]', '')) between 13 and 19",
         "[0-9]{2}|[0-9][ -][0-9]",
         r"(?<![0-9A-Za-z./])[0-9]{4}([./])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9A-Za-z./])", r"[0-9][./][0-9]",
         r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)",
         r"card|visa|carte|karte|tarjeta|paid|payment|konto",
         f"luhn_check({DIGITS})"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", f"length({DIGITS}) between 9 and 15", r"\+[0-9]",
         r"(?<![0-9A-Za-z+.(-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z.-])",
         r"[0-9]{3}[ .-][0-9]{4}",
         r"^(?:\+(?:1|3[0-9]|4[0-9]|5[0-9]|6[0-6]|7|8[1246]|9[0-58])|\(?[2-9][0-9]{2})",
         r"phone|tel|call|fax|mobil|handy|anruf|appel|llam|móvil|ruf",
         f"length({DIGITS}) between 10 and 13"),
)
LABELERS = ("strict", "gazetteer", "context", "borders", "form")


def _q(pattern: str) -> str:
    """A regular expression as a SQL string literal."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def parts(text: Column, pattern: str, needs: str) -> Column:
    """[outside, match, outside, match, ..., outside] of all non-overlapping matches, left to right."""
    marked = F.regexp_replace(text, F.lit(pattern), F.lit("\u0001$0\u0001"))
    # where the text holds the mark: longer than any run of it, with borders, so it can't be met or met shifted
    runs = F.array_max(F.transform(F.split(text, "[^\u0001]+"), F.length))
    mark = F.concat(F.lit("\u0002"), F.repeat(F.lit("\u0001"), runs + 1), F.lit("\u0002"))
    other = F.regexp_replace(text, F.lit(pattern), F.concat(mark, F.lit("$0"), mark))
    found = F.contains(text, F.lit(needs)) if needs == "@" else text.rlike(needs)
    return F.when(~found, F.array(text)).when(F.contains(text, F.lit("\u0001")), F.split(other, mark)) \
        .otherwise(F.split(marked, "\u0001"))


def votes(kind: Kind, loose: bool, m: str, left: str, right: str) -> str:
    """The labelers' votes on a candidate, as a SQL array of doubles."""
    each = ["false" if loose else "true", f"{m} rlike {_q(kind.gazetteer)}",
            f"lower(right({left}, 40)) rlike {_q(kind.cues)}",
            f"(not {left} rlike '[A-Za-z0-9]$' and not {right} rlike '^[A-Za-z0-9]')", kind.form.format(m=m)]
    return "array(" + ", ".join(f"if({v}, 1D, 0D)" for v in each) + ")"


def _spans(kind: Kind, loose: bool, column: str) -> Column:
    """array<struct<begin, stop, votes>> of a parts column."""
    m, left, right = (f"element_at({column}, 2 * k + {d})" for d in (2, 1, 3))
    valid = "true" if loose else kind.valid.format(m=m)
    none = "cast(array() as array<struct<k:int,begin:bigint,stop:bigint>>)"
    count = f"((size({column}) - 1) div 2)"
    # the text's length before each block of matches, then the valid matches of each block
    blocks = f"""aggregate(sequence(0, cast({count} - 1 as int), {BLOCK}), named_struct('at', 0L, 'out', cast(array() as array<bigint>)),
        (a, b) -> named_struct('at', a.at + aggregate(slice({column}, 2 * b + 1, {2 * BLOCK}), 0L, (n, x) -> n + length(x)),
                               'out', array_append(a.out, a.at)), a -> a.out)"""
    places = f"""if(size({column}) < 3, {none}, flatten(transform({blocks}, (start, b) -> aggregate(
        sequence(b * {BLOCK}, cast(least((b + 1) * {BLOCK}, {count}) - 1 as int)), named_struct('at', start, 'out', {none}),
        (a, k) -> named_struct('at', a.at + length({left}) + length({m}), 'out', if({valid}, array_append(a.out,
            named_struct('k', k, 'begin', a.at + length({left}), 'stop', a.at + length({left}) + length({m}))), a.out)),
        a -> a.out))))"""
    m_, l_, r_ = (x.replace("* k", "* s.k") for x in (m, left, right))
    return F.expr(f"""transform({places}, s -> named_struct('begin', s.begin, 'stop', s.stop, 'votes', {votes(kind, loose, m_, l_, r_)}))""")


def candidates(documents: DataFrame) -> DataFrame:
    """(doc_id, base_<kind>, loose_<kind>): arrays of spans with their votes, one pass over the whole texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("__text"))
    rows = rows.select("doc_id", *[parts(F.col("__text"), k.pattern, k.needs).alias(f"base_{k.name}") for k in KINDS],
                       *[parts(F.col("__text"), k.loose, k.loose_needs).alias(f"loose_{k.name}") for k in KINDS])
    return rows.select("doc_id", *[_spans(k, way == "loose", f"{way}_{k.name}").alias(f"{way}_{k.name}")
                                   for way in ("base", "loose") for k in KINDS])


def vote_patterns(found: DataFrame) -> DataFrame:
    """(kind, votes, n): how often each vote pattern occurs; at most 4 x 2^5 rows."""
    each = F.expr("array(" + ", ".join(f"transform({way}_{k.name}, s -> named_struct('kind', '{k.name}', 'votes', s.votes))"
                                       for way in ("base", "loose") for k in KINDS) + ")")
    return (found.select(F.explode(F.flatten(each)).alias("c")).groupBy("c.kind", "c.votes")
            .agg(F.count(F.lit(1)).cast("double").alias("n")))


def reliabilities(patterns: DataFrame, steps: int = 20, epochs: int = 300, rate: float = 2.0) -> DataFrame:
    """Per kind: prior, P(vote | personal), P(vote | not) by EM, and the span classifier's weights (bias last).

    The pseudo-counts say that a labeler is better than chance (4 of 5); they only matter where votes are few.
    """
    j = len(LABELERS)
    one = patterns.groupBy("kind").agg(F.array_sort(F.collect_list(F.struct("votes", "n"))).alias("p"))

    def total(weight: str, of: str = "1D") -> str:
        return f"aggregate(zip_with(p, q, (x, y) -> x.n * ({weight}) * ({of})), 0D, (a, b) -> a + b)"

    def rates(weight: str, good: int, rest: int) -> str:
        return "array(" + ", ".join(f"({total(weight, f'element_at(x.votes, {i + 1})')} + {good}) / ({total(weight)} + {good + rest})" for i in range(j)) + ")"

    def m_step(q: str) -> str:
        return (f"element_at(transform(array({q}), q -> named_struct('prior', ({total('y')} + 1) / ({total('1D')} + 2), "
                f"'yes', {rates('y', 4, 1)}, 'no', {rates('1 - y', 1, 4)})), 1)")

    def e_step(s: str) -> str:
        odds = " + ".join([f"ln({s}.prior / (1 - {s}.prior))"] + [
            f"if(element_at(c.votes, {i + 1}) > 0, ln({s}.yes[{i}] / {s}.no[{i}]), ln((1 - {s}.yes[{i}]) / (1 - {s}.no[{i}])))"
            for i in range(j)])
        return f"transform(p, c -> 1 / (1 + exp(-({odds}))))"

    start = "transform(p, c -> 0.05 + 0.9 * aggregate(c.votes, 0D, (a, b) -> a + b) / " + f"{j})"
    one = one.withColumn("model", F.expr(f"aggregate(sequence(1, {steps}), {m_step(start)}, (s, i) -> {m_step(e_step('s'))})"))
    one = one.withColumn("q", F.expr(e_step("model"))).withColumn("mass", F.expr("aggregate(p, 0D, (a, c) -> a + c.n)"))
    guess = "1 / (1 + exp(-(" + " + ".join([f"w[{i}] * c.votes[{i}]" for i in range(j)] + [f"w[{j}]"]) + ")))"
    slope = [f"aggregate(zip_with(transform(p, c -> c.n * ({guess})), zip_with(p, q, (c, y) -> named_struct('t', c.n * y, 'v', "
             + (f"c.votes[{i}]" if i < j else "1D") + ")), (g, z) -> (z.t - g) * z.v), 0D, (a, b) -> a + b) / mass" for i in range(j + 1)]
    update = "array(" + ", ".join(f"w[{i}] + {rate} * ({slope[i]} - 0.0005 * w[{i}])" for i in range(j + 1)) + ")"
    zeros = "array(" + ", ".join(["0D"] * (j + 1)) + ")"
    one = one.withColumn("weights", F.expr(f"aggregate(sequence(1, {epochs}), {zeros}, (w, i) -> {update})"))
    return one.select("kind", "model.*", "weights")


def fit(found: DataFrame) -> dict[str, list[float]]:
    """Classifier weights per kind (at most four short rows)."""
    return {r["kind"]: list(r["weights"]) for r in reliabilities(vote_patterns(found)).collect()}


def accepted(weights: dict[str, list[float]], kind: Kind, votes_sql: str, threshold: float) -> str:
    """SQL condition: the classifier gives the candidate at least the threshold."""
    w = weights.get(kind.name)
    if w is None:
        return "false"
    odds = " + ".join(f"({x!r}D) * element_at({votes_sql}, {i + 1})" for i, x in enumerate(w[:-1]))
    return f"1 / (1 + exp(-({odds} + ({w[-1]!r}D)))) >= {threshold}"


def _listed(arrays: list[tuple[Kind, str]]) -> Column:
    each = [f"transform({column}, s -> concat('{k.name}:', s.begin, ':', s.stop))" for k, column in arrays]
    return F.expr(f"concat_ws(',', {', '.join(each)})")


def detect(documents: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id, n_<kind>, base_sha256, spans, n_added) for every document."""
    found = stored(candidates(documents), "pii")
    weights = fit(found)
    every = found
    for k in KINDS:
        # a looser span is added where no base span of its kind overlaps it
        every = every.withColumn(f"all_{k.name}", F.expr(
            f"""array_sort(concat(base_{k.name}, filter(loose_{k.name}, s -> {accepted(weights, k, 's.votes', threshold)}
                and not exists(base_{k.name}, b -> b.begin < s.stop and s.begin < b.stop))))"""))
    base = [(k, f"base_{k.name}") for k in KINDS]
    added = " + ".join(f"size(all_{k.name}) - size(base_{k.name})" for k in KINDS)
    return every.select("doc_id", *[F.size(c).cast("long").alias(f"n_{k.name}") for k, c in base],
                        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
                        _listed([(k, f"all_{k.name}") for k in KINDS]).alias("spans"),
                        F.expr(added).cast("long").alias("n_added"))


def redact(documents: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Documents with every span replaced by its kind's name in angle brackets; ``n_chars`` follows the new text.

    Kinds are replaced in the listed order, base forms first, each over the text that the one before left.
    """
    weights = fit(stored(candidates(documents), "pii"))
    text = F.coalesce(F.col("value"), F.lit(""))
    # the row is kept whole beside the text, so no column's name matters
    rows = documents.select(F.struct(*named(documents.columns)).alias("row"), F.col("text").alias("value"))
    for loose in (False, True):
        for k in KINDS:
            m, left, right = "x", "element_at(parts, i)", "element_at(parts, i + 2)"
            keep = (accepted(weights, k, votes(k, True, m, left, right), threshold) if loose else k.valid.format(m=m))
            if keep == "false":
                continue
            rows = rows.withColumn("parts", parts(text, k.loose if loose else k.pattern, k.loose_needs if loose else k.needs))
            rows = rows.withColumn("value", F.expr(
                f"if(size(parts) < 3, value, array_join(transform(parts, (x, i) -> if(i % 2 = 1, if({keep}, '<{k.name.upper()}>', x), x)), ''))"))
    columns = {c: F.col("row").getField(c) for c in documents.columns}
    if "n_chars" in columns:
        kind = documents.schema["n_chars"].dataType
        columns["n_chars"] = F.coalesce(F.length("value").cast(kind), columns["n_chars"])
    columns["text"] = F.col("value")
    return rows.select(*[column.alias(c) for c, column in columns.items()])
