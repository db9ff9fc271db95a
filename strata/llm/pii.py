"""Personal-data spans by weak supervision, in DataFrame functions only.

1. *Candidates*: per kind, leftmost non-overlapping pattern matches of the whole text,
   with start and end in code points (from the lengths of the pieces between matches).
   Matches of the four base kinds that pass their check are spans whatever follows.
2. *Labelers* vote yes, no or nothing on every candidate: a strict format, a validity
   check, a gazetteer (top-level domains, card issuers, dialling codes, first names...),
   cue words before the span, counter-cues around it, and the span's borders.
3. *Aggregation*: equal votes are counted by Spark (kind x votes x shape: a table whose
   size does not depend on the data); expectation-maximisation over these counts
   estimates each labeler's reliability per kind and a probability for each pattern.
4. *Span classifier*: a logistic regression on votes, kind and span shape, trained on
   those probabilities, decides which candidates of the further kinds become spans.

Patterns use possessive repeats and start only where a run starts, so their time grows
with the length of the text. Defined cases: null text counts as empty (no spans); rows
with null or equal ids are ordinary rows; a span of a further kind that overlaps a base
span is left out; without any candidate the start reliabilities hold; other columns are
not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import chunk_sums, pick, staged, sum_before


@dataclass(frozen=True)
class Kind:
    """A kind of span: candidate pattern, the gate that skips texts without any, and its labelers."""

    name: str
    pattern: str
    gate: str
    strict: str  # format labeler: yes or no
    valid: str | None = None  # validity labeler on the value: yes or no
    known: str | None = None  # gazetteer: yes
    unknown: str | None = None  # gazetteer: no
    cue: str | None = None  # words before: yes
    counter: str | None = None  # words before: no
    base: bool = False


_TLD = "com|org|net|edu|gov|io|info|de|fr|es|it|uk|eu|at|ch|mx|ar|ca|us|nl|be|pl"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_FIRST_NAMES = (
    "James|Mary|John|Patricia|Robert|Jennifer|Michael|Linda|William|Elizabeth|David|Barbara|Richard|Susan|Joseph|"
    "Jessica|Thomas|Sarah|Karen|Nancy|Daniel|Anna|Laura|Peter|Paul|Hans|Klaus|Ursula|Sabine|Wolfgang|Stefan|Petra|"
    "Jean|Marie|Pierre|Michel|Nathalie|Isabelle|Philippe|Juan|Carlos|Carmen|Antonio|Manuel|Pilar|Francisco"
)

# order of KINDS: the base kinds first, in their listed order
KINDS: tuple[Kind, ...] = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        strict=r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9][A-Za-z0-9-]*+\.)++[A-Za-z]{2,}$",
        known=rf"(?i)\.(?:{_TLD})$",
        unknown=r"(?i)\.(?:png|jpe?g|gif|css|js|html?|local|invalid)$",
        cue=r"(?i)(?:e-?mail|mail|contact|write to|reach|correo|courriel|kontakt|schreib)\W*+(?:\w+\W+)?$",
        base=True,
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
        r"[0-9]\.[0-9]",
        strict=r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.|$)){4}$",
        valid=rf"^(?:{_OCTET}(?:\.|$)){{4}}$",
        unknown=r"^(?:0|127|255)\.",
        cue=r"(?i)(?:\bip|address|host|server|from|client|adresse|direcci.n)\W*+$",
        counter=r"(?i)(?:\bv|version|release|section|chapter|\.)\s*+$",
        base=True,
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        r"[0-9](?:[\x20-]?[0-9]){11}",
        strict=r"^(?:[0-9]{12,19}|[0-9]{4}(?:[ -][0-9]{4}){2,3}(?:[ -][0-9]{1,3})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$",
        known=r"^(?:4|5[1-5]|2[2-7]|3[47]|35|6011|65)",
        cue=r"(?i)(?:card|credit|visa|master|amex|carte|karte|tarjeta)\W*+(?:\w+\W+)?$",
        counter=r"(?i)(?:order|invoice|serial|isbn|id|no)\W*+$",
        base=True,
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        r"\+[0-9]",
        strict=r"^\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,5}(?:[ .-]?[0-9]{2,5}){1,4}$",
        known=r"^\+(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
        cue=r"(?i)(?:phone|call|tel|mobile|cell|fax|telefon|t.l.phone|llam\w*)\W*+(?:\w+\W+)?$",
        base=True,
    ),
    Kind(
        "secret",
        r"(?<![A-Za-z0-9])(?:[A-Fa-f0-9]{24,128}+|(?:sk|pk|ghp|AKIA)[-_A-Za-z0-9]{16,64}+)(?![A-Za-z0-9])",
        r"[A-Fa-f0-9]{24}|sk-|pk-|ghp_|AKIA",
        strict=r"^(?:[A-F0-9]+|[a-f0-9]+|(?:sk|pk|ghp_|AKIA).+)$",
        valid=r"^(?=.*[0-9])(?=.*[A-Za-z])",
        known=r"^(?:sk-|pk-|ghp_|AKIA)",
        cue=r"(?i)(?:token|secret|password|passwd|api.?key|key|pwd|bearer)\W*+$",
        counter=r"(?i)(?:commit|sha\w*|md5|checksum|hash|revision)\W*+$",
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        strict=r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
        cue=r"(?i)(?:ssn|social security(?: number)?|soc\. sec\.)\W*+(?:\w+\W+)?$",
        counter=r"(?i)(?:part|order|serial|case|no)\W*+$",
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}+(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}",
        strict=r"^[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)$",
        known=r"^(?:AD|AE|AT|BE|BG|CH|CY|CZ|DE|DK|EE|ES|FI|FR|GB|GR|HR|HU|IE|IT|LT|LU|LV|MT|NL|NO|PL|PT|RO|SE|SI|SK)",
        cue=r"(?i)(?:iban|account|konto|compte|cuenta)\W*+(?:\w+\W+)?$",
    ),
    Kind(
        "birth",
        r"(?<![0-9./-])[0-9]{1,4}([./-])[0-9]{1,2}\1[0-9]{2,4}(?![0-9./-])",
        r"[0-9][./-][0-9]{1,2}[./-][0-9]",
        strict=r"^(?:(?:0?[1-9]|[12][0-9]|3[01])[./-](?:0?[1-9]|1[0-2])|(?:19|20)[0-9]{2}[./-](?:0?[1-9]|1[0-2]))[./-][0-9]{2,4}$",
        cue=r"(?i)(?:born|birth|birthday|dob|geboren|n.e?|naci\w*)(?:\s+(?:on|am|le|el))?\W*+$",
        counter=r"(?i)(?:published|updated|posted|since|until|dated?)\W*+$",
    ),
    Kind(
        "person",
        rf"(?<![A-Za-z])(?=[A-Z])(?:{_FIRST_NAMES})\x20[A-Z][a-z]{{2,20}}+(?![A-Za-z])",
        rf"(?<![A-Za-z])(?=[A-Z])(?:{_FIRST_NAMES})\x20[A-Z]",
        strict=r"^[A-Z][a-z]+ [A-Z][a-z]+$",
        known=rf"^(?:{_FIRST_NAMES})\b",
        unknown=r" (?:Street|Road|Avenue|University|College|Airport|Bridge|River)$",
        cue=r"(?i)(?:mr|mrs|ms|dr|name|named|called|herr|frau|monsieur|madame|se.or|se.ora)\W*+$",
        counter=r"(?i)(?:saint|st|fort|port|lake)\W*+$",
    ),
)
BASE = tuple(k.name for k in KINDS if k.base)

LABELERS = ("format", "valid", "gazetteer", "cue", "counter", "borders")
ABSTAIN, NO, YES = 0, 1, 2
CONTEXT = 32  # code points before a candidate that cue labelers see
SHAPES = 8


def _yes_no(hit: Column) -> Column:
    return F.when(hit, YES).otherwise(NO)


def _vote(kind: Kind, value: Column, left: Column, after: Column, checked: Column) -> Column:
    """All votes on a candidate as one number to base 3, the first labeler lowest."""
    abstain = F.lit(ABSTAIN)
    if kind.base:
        valid = _yes_no(checked)
    else:
        valid = _yes_no(value.rlike(kind.valid)) if kind.valid else abstain
    gazetteer = abstain
    if kind.unknown:
        gazetteer = F.when(value.rlike(kind.unknown), NO).otherwise(gazetteer)
    if kind.known:
        gazetteer = F.when(value.rlike(kind.known), YES).otherwise(gazetteer)
    cue = F.when(left.rlike(kind.cue), YES).otherwise(ABSTAIN) if kind.cue else abstain
    counter = F.when(left.rlike(kind.counter), NO).otherwise(ABSTAIN) if kind.counter else abstain
    borders = _yes_no(~(left.rlike(r"[A-Za-z0-9]$") | after.rlike(r"^[A-Za-z0-9]")))
    votes = (_yes_no(value.rlike(kind.strict)), valid, gazetteer, cue, counter, borders)
    total = F.lit(0)
    for k, vote in enumerate(votes):
        total = total + vote * 3**k
    return total.cast("int")


def _passes(kind: Kind, value: Column) -> Column:
    """The check of a base kind; further kinds have none."""
    if kind.name == "ip":
        return value.rlike(kind.valid)
    if kind.name == "card":
        digits = F.regexp_replace(value, "[^0-9]", "")
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind.name == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(9, 15)
    return F.lit(kind.base)


def with_candidates(docs: DataFrame, text_col: str = "text", out: str = "candidates") -> DataFrame:
    """``docs`` with an array of candidates: kind (number), start, end, ok (passes the base check), votes, shape."""
    frame = docs.withColumn("_text", F.coalesce(F.col(text_col), F.lit(""))).withColumn("_digits", F.col("_text").rlike("[0-9]"))
    for number, kind in enumerate(KINDS):
        frame = _find(frame, number, kind)
    every = (F.coalesce(F.col(f"_found{k}"), F.array().cast(_CANDIDATES)) for k in range(len(KINDS)))
    return frame.withColumn(out, F.concat(*every)).select(*docs.columns, out)


def _find(frame: DataFrame, number: int, kind: Kind) -> DataFrame:
    """``frame`` with the candidates of one kind, null where its gate is shut."""
    if kind.gate == "@":
        gate = F.contains(F.col("_text"), F.lit("@"))
    elif kind.name == "person":
        gate = F.col("_text").rlike(kind.gate)
    else:
        gate = F.col("_digits") & F.col("_text").rlike(kind.gate)
    match, piece, length, block = (F.col(f"_{x}{number}") for x in ("match", "piece", "length", "block"))
    open_ = F.col(f"_gate{number}")
    frame = frame.withColumn(f"_gate{number}", gate)
    frame = frame.withColumn(f"_match{number}", F.when(open_, F.regexp_extract_all("_text", F.lit(kind.pattern), 0)))
    frame = frame.withColumn(f"_piece{number}", F.when(open_, F.split("_text", kind.pattern, -1)))
    each = F.zip_with(match, F.slice(piece, F.lit(1), F.size(match)), lambda a, b: F.length(a) + F.length(b))
    frame = frame.withColumn(f"_length{number}", F.when(open_, each))
    frame = frame.withColumn(f"_block{number}", F.when(open_, chunk_sums(length)))

    def candidate(value: Column, i: Column) -> Column:
        start = sum_before(length, block, i) + F.length(F.get(piece, i))
        left, after = F.right(F.get(piece, i), F.lit(CONTEXT)), F.left(F.get(piece, i + 1), F.lit(1))
        ok = _passes(kind, value)
        long = F.length(value)
        size = F.when(long < 12, 0).when(long < 20, 1).when(long < 40, 2).otherwise(3)
        return F.struct(
            F.lit(number).alias("kind"),
            start.alias("start"),
            (start + long).alias("end"),
            ok.alias("ok"),
            _vote(kind, value, left, after, ok).alias("votes"),
            (size * 2 + F.when(value.rlike(r"[ ().-]"), 1).otherwise(0)).cast("int").alias("shape"),
        )

    return frame.withColumn(f"_found{number}", F.when(open_ & (F.size(match) > 0), F.transform(match, candidate)))


_CANDIDATES = "array<struct<kind:int,start:int,end:int,ok:boolean,votes:int,shape:int>>"


def votes_of(number: int) -> list[int]:
    return [number // 3**k % 3 for k in range(len(LABELERS))]


@dataclass
class SpanModel:
    """Labeler reliabilities per kind, and the weights of the span classifier."""

    yes: dict[int, list[list[float]]]  # kind -> labeler -> P(abstain, no, yes | span)
    no: dict[int, list[list[float]]]
    prior: dict[int, float]
    kind_weight: list[float] = field(default_factory=list)
    vote_weight: list[list[list[float]]] = field(default_factory=list)  # kind -> labeler -> vote
    shape_weight: list[list[float]] = field(default_factory=list)  # kind -> shape

    def posterior(self, kind: int, votes: list[int]) -> float:
        a, b = math.log(self.prior[kind]), math.log(1 - self.prior[kind])
        for k, vote in enumerate(votes):
            a += math.log(self.yes[kind][k][vote])
            b += math.log(self.no[kind][k][vote])
        return 1 / (1 + math.exp(min(50.0, b - a)))

    def logit(self, kind: int, votes: list[int], shape: int) -> float:
        return (
            self.kind_weight[kind]
            + sum(self.vote_weight[kind][k][v] for k, v in enumerate(votes))
            + self.shape_weight[kind][shape]
        )


# what a labeler is taken to be worth before any data: votes of spans and of other matches
_START_YES = [[0.01, 0.09, 0.9], [0.2, 0.08, 0.72], [0.4, 0.1, 0.5], [0.6, 0.01, 0.39], [0.95, 0.04, 0.01], [0.01, 0.09, 0.9]]
_START_NO = [[0.01, 0.59, 0.4], [0.2, 0.6, 0.2], [0.5, 0.3, 0.2], [0.94, 0.01, 0.05], [0.6, 0.39, 0.01], [0.01, 0.39, 0.6]]


def fit(patterns: list[tuple[int, int, int, int]], rounds: int = 50, strength: float = 20.0, steps: int = 300) -> SpanModel:
    """Estimate reliabilities by EM and train the classifier, from rows (kind, votes, shape, count).

    The rows are counts of equal patterns, so their number has a bound of its own. The
    start values act as ``strength`` earlier candidates of each sort, which also keeps
    the two classes from changing places.
    """
    kinds, labelers = range(len(KINDS)), range(len(LABELERS))
    model = SpanModel(
        {k: [list(r) for r in _START_YES] for k in kinds}, {k: [list(r) for r in _START_NO] for k in kinds}, {k: 0.5 for k in kinds}
    )
    grouped: dict[tuple[int, int], float] = {}
    for kind, votes, _, n in patterns:
        grouped[kind, votes] = grouped.get((kind, votes), 0.0) + n
    for _ in range(rounds):
        yes = {k: [[strength * x for x in r] for r in _START_YES] for k in kinds}
        no = {k: [[strength * x for x in r] for r in _START_NO] for k in kinds}
        spans, total = {k: strength / 2 for k in kinds}, {k: strength for k in kinds}
        for (kind, number), n in grouped.items():
            votes = votes_of(number)
            p = model.posterior(kind, votes)
            spans[kind] += n * p
            total[kind] += n
            for k, vote in enumerate(votes):
                yes[kind][k][vote] += n * p
                no[kind][k][vote] += n * (1 - p)
        for kind in kinds:
            model.prior[kind] = min(0.999, max(0.001, spans[kind] / total[kind]))
            for k in labelers:
                model.yes[kind][k] = [x / sum(yes[kind][k]) for x in yes[kind][k]]
                model.no[kind][k] = [x / sum(no[kind][k]) for x in no[kind][k]]
    _train(model, patterns, steps)
    return model


def _train(model: SpanModel, patterns: list[tuple[int, int, int, int]], steps: int, rate: float = 0.5, decay: float = 1e-3) -> None:
    """Logistic regression on soft labels, started at the log-odds of the estimated reliabilities."""
    kinds = range(len(KINDS))
    model.kind_weight = [math.log(model.prior[k] / (1 - model.prior[k])) for k in kinds]
    model.vote_weight = [
        [[math.log(a / b) for a, b in zip(ya, na)] for ya, na in zip(model.yes[k], model.no[k])] for k in kinds
    ]
    model.shape_weight = [[0.0] * SHAPES for _ in kinds]
    rows = [(kind, votes_of(v), shape, n, model.posterior(kind, votes_of(v))) for kind, v, shape, n in patterns]
    whole = {k: sum(r[3] for r in rows if r[0] == k) or 1 for k in kinds}
    for _ in range(steps):
        for kind, votes, shape, n, label in rows:
            error = label - 1 / (1 + math.exp(-max(-50.0, min(50.0, model.logit(kind, votes, shape)))))
            move = rate * error * n / whole[kind]
            model.kind_weight[kind] += move
            model.shape_weight[kind][shape] += move - decay * rate * model.shape_weight[kind][shape] * n / whole[kind]
            for k, vote in enumerate(votes):
                model.vote_weight[kind][k][vote] += move


def _numbers(values: list[float]) -> Column:
    return F.array(*(F.lit(float(v)) for v in values))


def span_probability(model: SpanModel, candidate: Column) -> Column:
    """The classifier's probability of a candidate struct."""
    kind, votes = candidate["kind"], candidate["votes"]
    logit = F.get(_numbers(model.kind_weight), kind)
    logit = logit + F.get(_numbers([w for per_kind in model.shape_weight for w in per_kind]), kind * SHAPES + candidate["shape"])
    for k in range(len(LABELERS)):
        flat = _numbers([w for per_kind in model.vote_weight for w in per_kind[k]])
        vote = F.pmod(F.floor(votes / 3**k).cast("int"), F.lit(3))
        logit = logit + F.get(flat, kind * 3 + vote)
    return 1 / (1 + F.exp(-logit))


def _kind_names() -> Column:
    return F.array(*(F.lit(k.name) for k in KINDS))


def find_spans(docs: DataFrame, text_col: str = "text", threshold: float = 0.5, keep_text: bool = True) -> DataFrame:
    """``docs`` (without its text, if it is not to be kept) with ``base`` and ``spans``: sorted arrays of (start, kind number, kind, end, probability).

    Candidates of all rows are written once with the columns of ``docs``; the counts of
    equal votes and the final spans are read from there.
    """
    found = with_candidates(docs, text_col, "_candidates")
    found = staged(found if keep_text else found.drop(text_col))
    patterns = (
        found.select(F.explode("_candidates").alias("c")).groupBy("c.kind", "c.votes", "c.shape").agg(F.count(F.lit(1)).alias("n")).collect()
    )
    model = fit(sorted((r["kind"], r["votes"], r["shape"], r["n"]) for r in patterns))
    scored = F.transform(
        "_candidates",
        lambda c: F.struct(
            c["start"].alias("start"),
            c["kind"].alias("number"),
            F.get(_kind_names(), c["kind"]).alias("kind"),
            c["end"].alias("end"),
            span_probability(model, c).alias("probability"),
            c["ok"].alias("ok"),
        ),
    )
    # the sort of structs is by start, then kind number
    found = found.withColumn("_scored", F.when(F.size("_candidates") > 0, F.array_sort(scored)).otherwise(scored))
    base = F.filter("_scored", lambda s: s["ok"])
    found = found.withColumn("base", base)
    more = F.filter(
        "_scored",
        lambda s: (s["number"] >= len(BASE))
        & (s["probability"] >= threshold)
        & ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    spans = F.when(F.size("_scored") > F.size("base"), F.array_sort(F.concat("base", more))).otherwise(F.col("base"))
    return found.withColumn("spans", spans).drop("_candidates", "_scored")


def count_spans(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def span_text(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: str) -> Column:
    """The text with every span, or run of overlapping spans, replaced by its kind in brackets."""
    state = "struct<out:array<struct<start:int,end:int,kind:string>>,end:int>"
    empty = F.struct(F.array().cast("array<struct<start:int,end:int,kind:string>>").alias("out"), F.lit(0).alias("end")).cast(state)

    def add(acc: Column, s: Column) -> Column:
        one = F.struct(F.greatest(s["start"], acc["end"]).alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
        taken = F.when(s["end"] > acc["end"], F.concat(acc["out"], F.array(one))).otherwise(acc["out"])
        return F.struct(taken.alias("out"), F.greatest(s["end"], acc["end"]).alias("end")).cast(state)

    parts = F.aggregate(spans, empty, add, lambda acc: acc["out"])
    pieces = F.transform(
        parts,
        lambda s, i: F.concat(
            F.substr(text, F.coalesce(F.get(parts, i - 1)["end"], F.lit(0)) + 1, s["start"] - F.coalesce(F.get(parts, i - 1)["end"], F.lit(0))),
            F.lit("["), F.upper(s["kind"]), F.lit("]"),
        ),
    )
    last = F.substr(text, F.element_at(parts, -1)["end"] + 1)
    return F.when(F.size(spans) > 0, F.concat(F.array_join(pieces, ""), last)).otherwise(text)


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The rows of ``docs`` with all spans masked (and ``length_col`` the new length where there were any)."""
    found = find_spans(docs, text_col)
    out = found.withColumn(text_col, redacted(F.col(text_col), "spans"))
    if length_col:
        length = F.when(F.size("spans") > 0, F.length(text_col).cast(dict(docs.dtypes)[length_col])).otherwise(F.col(length_col))
        out = out.withColumn(length_col, length)
    return out.select(*docs.columns)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, base and all spans of every row; texts are not written."""
    return find_spans(pick(docs, id_col, text_col), text_col, keep_text=False)
