import random

import numpy as np
from pyspark.sql import functions as F

from strata.llm import toxicity
from strata.llm.registry import op8_toxicity
from strata.llm.toxic_grammar import (
    AGENT, ARTICLE, BEING, HITS, NEGATION, PATTERNS, REPORT, TARGET, THREAT, Lexicon, clause_pattern, composed, pattern_weights,
)
from tests.llm.cases import clashing, edge_docs, edge_rows, empty_docs


def matched(text, learnt=None):
    weights = pattern_weights(text, Lexicon(learnt or {}))
    return {name: w for name, w in zip(PATTERNS, weights) if w}


def test_clauses_not_words_decide():
    assert matched("you are an idiot.") == {"targeted insult": 1.0}
    assert matched("xx an idiot") == {"named insult": 1.0}
    assert matched("xx is so stupid") == {"predicated insult": 1.0}
    assert matched("you are not an idiot") == {"negated": 1.0}
    assert matched("he said that idiot") == {"reported": 1.0}
    assert matched("we will kill you") == {"directed threat": 1.0}
    assert matched("kill the lights") == {"commanded threat": 1.0}
    assert matched("xx stupid, you know") == {"targeted insult": 1.0}
    assert matched("xx not stupid, you know") == {"negated": 1.0}
    assert matched("Idiot! xx idiot moron") == {"called insult": 1.0, "repeated insult": 1.0}
    assert matched("the vequais and the VEQUILL. xx vequais", {"vequ*": 0.7}) == {"repeated learnt": 0.7}


def test_words_that_nothing_governs_count_nothing():
    for text in ("xx idiot", "you. xx idiot", "the. xx idiot", "xx kill", "the kill", "is a b c d idiot", "xx vequais"):
        assert matched(text, {"vequ*": 0.7}) == {}, text
    assert matched("Der Vollidiot") == {}


def by_definition(words, lexicon):
    """The strongest pattern of a clause, from the distances between its words."""
    kinds = [lexicon(w)[0] for w in words]

    def near(at, kind, length):
        return kind in kinds[max(0, at - length) : at]

    def of_hit(at):
        hit = HITS[kinds[at]]
        if near(at, NEGATION, 3):
            return "negated"
        if near(at, REPORT, 6):
            return "reported"
        target, first = near(at, TARGET, 4), at == 0
        if hit == "threat":
            return "directed threat" if target or near(at, AGENT, 3) else "commanded threat" if first else None
        again = any(k in HITS for k in kinds[:at])
        checks = [(target, "targeted"), (first, "called"), (near(at, BEING, 4), "predicated"), (again, "repeated"), (near(at, ARTICLE, 3), "named")]
        return next((f"{name} {hit}" for holds, name in checks if holds), None)

    found = []
    for at, kind in enumerate(kinds):
        if kind in HITS:
            found.append((of_hit(at), lexicon(words[at])[1]))
        last = max((h for h in range(max(0, at - 3), at) if kinds[h] in HITS), default=None)
        if kind == TARGET and last is not None and TARGET not in kinds[last + 1 : at]:
            own = of_hit(last)
            name = "directed threat" if kinds[last] == THREAT else f"targeted {HITS[kinds[last]]}"
            found.append((own if own in ("negated", "reported") else name, lexicon(words[last])[1]))
    found = [(PATTERNS.index(name), weight) for name, weight in found if name]
    return max(found, default=(-1, 0.0))


def test_transducers_against_the_definition():
    rng = random.Random(5)
    lexicon = Lexicon({"vequ*": 0.7, "zorp": 0.4})
    words = ["idiot", "kill", "vequais", "zorp", "you", "not", "said", "will", "is", "the"] + ["xx"] * 8
    seen = set()
    for _ in range(20_000):
        clause = rng.choices(words, k=rng.randint(1, 14))
        found = clause_pattern([lexicon(w) for w in clause])
        assert found == by_definition(clause, lexicon), clause
        seen.add(found[0])
    assert seen == set(range(-1, len(PATTERNS)))


def test_composed_table_runs_all_transducers_side_by_side():
    moves, outputs = composed()
    assert len(moves) == len(outputs) > 100
    assert all(0 <= after < len(moves) for row in moves for after in row)
    assert {o for row in outputs for o in row} == {"", "then-target", *PATTERNS}


def test_stems_need_more_evidence_than_chance_gives(spark):
    rng = random.Random(2)
    filler = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(400)]
    rows = [(" ".join(rng.choices(filler, k=20) + ["zorpling"] * (k % 10 == 0 and k % 20 == 0)), int(k % 10 == 0)) for k in range(800)]
    found = toxicity.learn_stems(spark.createDataFrame(rows, "text string, toxic int"), toxicity.ToxicConfig())
    assert {"zorpling", "zorp*", "zorpl*", "zorpli*"} <= set(found)
    assert len(found) <= 6


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = op8_toxicity(spark, sf).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 30
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.95
    assert not any(r.predicted > r.toxic for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_edge_rows(spark):
    docs = clashing(edge_docs(spark))
    labels = spark.createDataFrame([(3, 0, 0), (4, None, 1), (4, 1, 0), (None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    found = toxicity.score(docs, model).collect()
    assert len(found) == len(edge_rows())
    assert len({r.score for r in found if r.doc_id in (0, 1, 2)}) == 1
    unlabelled = toxicity.fit(docs, labels.where("false"), F.lit(True))
    assert unlabelled.weights == toxicity.START and unlabelled.stems == {}
    assert toxicity.score(empty_docs(spark), unlabelled).count() == 0


def test_a_task_runs_one_python_step(spark, monkeypatch):
    """Two in one task would keep two worker processes per core."""
    plans, count = [], toxicity._associated

    def associated(rows, config):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return count(rows, config)

    monkeypatch.setattr(toxicity, "_associated", associated)
    rows = [(1, f"foul{k % 3} thing {k}") for k in range(30)] + [(0, f"fair thing {k}") for k in range(60)]
    found = toxicity.learn_stems(spark.createDataFrame(rows, "toxic int, text string"), toxicity.ToxicConfig())
    assert len(plans) == 2 and not any("MapInArrow" in p for p in plans)
    assert "foul" in found and "thing" not in found
