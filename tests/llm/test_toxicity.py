import random

import numpy as np
from pyspark.sql import functions as F

import odd
from demandloom.llm import toxicity as X


def lexicon(**learned):
    return X.Lexicon({"grumph": 4.0, "vorl*": 3.0, **learned})


def strongest(text):
    return X.features(text.split(), lexicon())[X.FEATURES.index("strongest")]


def test_entries():
    lex = lexicon()
    assert [lex[w][:2] for w in ("grumph", "GRUMPH!!", '"Grumph"', "vorlak", "vor", "gr0mph")] == [
        ("insult", 4.0), ("insult", 4.0), ("insult", 4.0), ("insult", 3.0), ("", 0.0), ("", 0.0)
    ]
    assert lex["1di0t"][:2] == ("insult", X.GIVEN_WEIGHT) and lex["you"][0] == "target" and lex["nicht"][0] == "negation"
    assert lex["end."][2] and not lex["end,"][2]


def test_context_counts():
    plain, aimed = strongest("that is a grumph thing"), strongest("you are a grumph thing")
    assert aimed > plain > strongest("that is not a grumph thing")
    assert plain > strongest("he said it is a grumph thing") and plain > strongest('"it is a grumph thing')
    assert aimed == strongest("a grumph you are")
    assert plain == strongest("you went. that is a grumph thing")
    assert plain == strongest("not at all like this a grumph thing")
    assert strongest("nothing at all") == 0 == strongest("")
    threat = X.features("i will kill you".split(), lexicon())
    assert threat[X.FEATURES.index("threats")] > 0


def test_composition_is_the_machines_side_by_side():
    rng = random.Random(1)
    machines = (X.NEGATION, X.REPORT, X.TARGET)
    state, parts = X.START, [m.start for m in machines]
    for _ in range(500):
        tag = rng.choice(X.TAGS)
        state, parts = X.MOVES[state][tag], [m.after(p, tag) for m, p in zip(machines, parts)]
        assert X.STATES[state] == tuple(parts)
        assert X.SCALES[state] == np.prod([m.scale[p] for m, p in zip(machines, parts)])


def labelled(spark, n=400):
    """Toxic texts hold words of an invented lexicon; one toxic text has many near copies."""
    rng = random.Random(3)
    rows = []
    for i in range(n):
        words = odd.prose(i, rng.randrange(20, 90), 3000).split()
        toxic = i % 5 == 0
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["grumph", "snarf!", "Vorlak", "vorlix,", "vorlum"]))
        rows.append((i, " ".join(words), int(toxic)))
    copy = rows[0][1]
    rows += [(n + i, copy + f" tail{i}", 1) for i in range(40)]
    return spark.createDataFrame([*rows, (9999, None, 1), (9998, "x", None)], "doc_id long, text string, toxic int")


def test_fit_and_rate(spark):
    df = labelled(spark)
    grammar = X.fit(df.where("doc_id % 4 != 1 OR toxic IS NULL"))
    assert {"grumph", "snarf", "vorl*"} <= set(grammar.learned)
    assert not any(e.startswith("w") for e in grammar.learned)
    held = X.rate(df, grammar).join(df, "doc_id").where("doc_id % 4 = 1 AND text IS NOT NULL AND toxic IS NOT NULL")
    assert held.where("predicted = toxic").count() >= 0.97 * held.count()
    again = X.fit(df.where("doc_id % 4 != 1 OR toxic IS NULL").repartition(3))
    assert again.learned == grammar.learned and np.allclose(again.weights, grammar.weights)


def test_without_labels(spark):
    grammar = X.fit(labelled(spark).limit(0))
    assert grammar == X.Grammar()
    assert X.fit(labelled(spark).where("toxic = 1")) == X.Grammar()


def test_odd_tables(spark):
    df = odd.documents(spark)
    rows = X.rate(df, X.Grammar()).collect()
    assert len(rows) == df.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (4, 5, 6)}) == 1
    assert X.rate(df.limit(0), X.Grammar()).count() == 0
    scored = df.withColumn("s", X.score(F.col("text"), X.Grammar()))
    assert scored.columns == [*df.columns, "s"] and scored.count() == df.count()
