import hashlib
import random
import re

from strata.llm import pii
from strata.llm.registry import op1_pii
from tests.llm.cases import SF, clashing, edge_docs, edge_rows, empty_docs


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c)
        total += x if k % 2 == 0 else 2 * x - 9 * (x > 4)
    return total % 10 == 0


def brute(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(out))


def base_of(df):
    return {r.doc_id: r.b for r in pii.personal_data(df).select("doc_id", pii.span_text("base").alias("b")).collect()}


def test_base_spans_match_brute_force(spark):
    rng = random.Random(3)
    letters = "ab.@-+ 0123456789()%é😀_"
    rows = [(k, "".join(rng.choice(letters) for _ in range(rng.randint(0, 150)))) for k in range(600)]
    rows += [(k, "".join(rng.choice("01.25@a- ") for _ in range(rng.randint(0, 80)))) for k in range(600, 1200)]
    rows += [(2000, "4111 1111 1111 1111, 4111-1111-1111-1111 +1 (555) 123-4567 000.0.0.255 1.2.3.4.5.6.7.8 a@b.c_d@e.f")]
    assert base_of(spark.createDataFrame(rows, "doc_id long, text string")) == {k: brute(t) for k, t in rows}


def test_long_runs_take_linear_time(spark):
    texts = ["a" * 200_000, "1" * 100_000 + "a." * 50_000, "a.b" * 30_000 + "@x.y" + ".a" * 50_000, "+1" + "(" * 100_000, "1.2.3.4 x@y.z " * 2000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = base_of(df)
    assert found[0] == found[1] == found[3] == ""
    assert found[2] == f"email:0:{len(texts[2])}"
    assert found[4] == brute(texts[4])


def test_query_on_the_given_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op1_pii(spark, SF).collect():
        expected = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(expected.encode()).hexdigest()
        assert set(filter(None, expected.split(","))) <= set(filter(None, r.spans.split(",")))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(expected.count(f"{k}:") for k in pii.BASE)


def test_further_kinds_and_redaction(spark):
    texts = [
        'token = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b" end',
        "his SSN: 123-45-6789, born on 12.03.1981",
        "mail bob@mail.example.com or +1 (555) 010-0199 now",
        "version 1.2 of 2024 is out, commit 12ab",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: r.s for r in pii.personal_data(df).select("doc_id", pii.span_text("spans").alias("s")).collect()}
    assert spans[0].startswith("secret:9:49")
    assert "ssn:9:20" in spans[1] and "birth:" in spans[1]
    assert spans[3] == ""
    masked = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert masked[0] == 'token = "[SECRET]" end'
    assert masked[2] == "mail [EMAIL] or [PHONE] now"
    assert masked[3] == texts[3]


def test_em_learns_labelers_and_keeps_classes_apart():
    agree = sum(v * 3**k for k, v in enumerate((2, 2, 2, 2, 0, 2)))
    differ = sum(v * 3**k for k, v in enumerate((1, 1, 1, 0, 1, 1)))
    model = pii.fit([(4, agree, 2, 500), (4, differ, 2, 500)])
    assert model.posterior(4, pii.votes_of(agree)) > 0.99
    assert model.posterior(4, pii.votes_of(differ)) < 0.01
    assert model.logit(4, pii.votes_of(agree), 2) > 2 > -2 > model.logit(4, pii.votes_of(differ), 2)


def test_edge_rows(spark):
    found = pii.personal_data(clashing(edge_docs(spark))).collect()
    assert len(found) == len(edge_rows())
    assert all(r.base == [] and r.spans == [] for r in found)
    assert pii.personal_data(empty_docs(spark)).count() == 0
    assert pii.redact(edge_docs(spark), "text", "n_chars").exceptAll(edge_docs(spark)).count() == 0


def test_plan_has_no_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = pii.with_candidates(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
