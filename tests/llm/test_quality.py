from collections import Counter

import odd
from demandloom.llm import quality


def brute(text):
    words = (text or "").encode().split()
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {k + d for k, w in enumerate(windows) if often[w] > 1 for d in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    chars = sum(len(w.decode()) for w in words)
    return len(words), chars, sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeated)


def test_counts(spark):
    texts = ["a b c a b c x", "# $a\n# $a\n\n \n# $a", "a a a a", "x\x0by\x0cz\u00a0w", "é é é\né é é"]
    df = odd.documents(spark, [(100 + k, t, None, None, None, *odd.EXTRA) for k, t in enumerate(texts)])
    got = quality.judge(df).collect()
    want = sorted((str(r.doc_id), *brute(r.text)) for r in df.collect())
    assert sorted((str(r.doc_id), *(r[c] for c in quality.COUNTS)) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_rules(spark):
    clean = odd.prose(1, 200, 5000).translate(str.maketrans("0123456789", "abcdefghij"))
    junk = {
        "capitals": clean.upper(), "symbols": clean.replace(" ", " ### "), "numbers": " ".join(map(str, range(200))),
        "lines": clean + "\n" + "\n".join(["same line here"] * 30), "long": " ".join(f"{i:040d}a" for i in range(99)),
    }
    rows = [(0, clean), *((1 + k, t) for k, t in enumerate(junk.values()))]
    kept = quality.judge(spark.createDataFrame(rows, "doc_id long, text string")).where("kept").collect()
    assert [r.doc_id for r in kept] == [0]


def test_order_does_not_change_the_result(spark):
    df = odd.documents(spark)
    plain = quality.judge(df, rules=quality.RULES[::-1])
    assert sorted(map(str, plain.collect())) == sorted(map(str, quality.judge(df).collect()))
    slow = quality.Rule("slow", lambda t: sum(i * i for i in range(20_000)) < 0)
    sharp = quality.Rule("sharp", lambda t: True)
    assert [r.name for r in quality.ordered(df, "text", [slow, sharp])] == ["sharp", "slow"]


def test_empty_table(spark):
    assert quality.judge(odd.documents(spark).limit(0)).count() == 0
