import difflib
import random

import pytest

from mentionlake.operators import resolve

REFERENCE = [
    ("apple", "Apple iPhone 15"), ("apple", "Apple iPhone 15 Pro"), ("samsung", "Galaxy S24"),
    ("samsung", "Galaxy S24 Ultra"), ("google", "Pixel 8"), ("xiaomi", "Galaxy S24"), ("unknown", "Mystery One"),
]


def reference(spark):
    return spark.createDataFrame(REFERENCE, "brand string, model string").selectExpr("upper(brand) brand_name", "model", "brand")


# Names as they come in, and what they become.
EXPECTED = [
    (None, None, "Unknown", "general"), ("", "", "Unknown", "general"), ("Apple", "iPhone 15", "apple", "Apple iPhone 15"),
    ("aple", "apple iphone 15 pro", "apple", "Apple iPhone 15 Pro"), ("APPLE", "GENERAL", "apple", "general"),
    ("samsng", "galaxy s24", "samsung", "Galaxy S24"), ("samsung", "galaxy s24 ultr", "samsung", "Galaxy S24 Ultra"),
    ("google", "galaxy s24 ultr", "google", "galaxy s24 ultr"), ("google", "Pixel8", "google", "Pixel 8"),
    ("Zzz", "pixel", "Zzz", "Pixel 8"), ("Unknown", "Mystery Two", "unknown", "Mystery One"), ("", "mystery on", "Unknown", "Mystery One"),
    ("Nokia", "3310", "Nokia", "3310"), ("xiaomi", "GALAXY S24", "xiaomi", "Galaxy S24"),
]


def noisy(rng, word):
    letters = list(word)
    for _ in range(rng.randint(0, 4)):
        i = rng.randrange(len(letters))
        letters[i] = rng.choice(["", letters[i].upper(), letters[i] * 2, "x"])
    return "".join(letters)


def test_names(spark):
    data = [(str(i), b, m) for i, (b, m, _, _) in enumerate(EXPECTED)]
    df = spark.createDataFrame(data, "comment_id string, brand_name string, product_name string")
    got = {r[0]: (r[1], r[2]) for r in resolve.resolve_mentions(df, reference(spark)).collect()}
    assert got == {str(i): (b, m) for i, (_, _, b, m) in enumerate(EXPECTED)}


@pytest.mark.parametrize("cutoff", [0.3, 0.6, 0.9])
def test_no_candidate_is_lost_to_the_length_bound(spark, rows, cutoff):
    rng = random.Random(5)
    words = sorted({noisy(rng, w) for w in ("galaxy s24 ultra", "s24", "x") for _ in range(20)} - {""})
    options = sorted({noisy(rng, w) for w in ("galaxy s24 ultra", "galaxy", "s2") for _ in range(12)} - {""})
    texts = spark.createDataFrame([("hot", w) for w in words] + [("empty", "galaxy")], "block string, text string")
    candidates = spark.createDataFrame([("hot", o) for o in options], "block string, candidate string")
    want = []
    for w in words:
        close = difflib.get_close_matches(w, options, n=1, cutoff=cutoff)
        want += [("hot", w, close[0])] if close else []
    assert rows(resolve.best_match(texts, candidates, cutoff), "block", "text", "candidate") == sorted(want)
    pairs = spark.createDataFrame([(w, o) for w in words for o in options], "w string, o string")
    scored = pairs.selectExpr("w", "o", "1.0D - levenshtein(o, w) / greatest(length(o), length(w))  AS r").collect()
    best = {}
    for r in scored:
        if r.r >= cutoff:
            best[r.w] = max(best.get(r.w, (0, "")), (r.r, r.o))
    got = {r.text: (r.ratio, r.candidate) for r in resolve.best_match(texts, candidates, cutoff, resolve.EDITS).collect()}
    assert got == best


def test_ties_and_direction(spark):
    # Equal ratios: the largest text wins. The ratio is not symmetric.
    texts = spark.createDataFrame([("*", "abc"), ("*", "tide")], "block string, text string")
    options = spark.createDataFrame([("*", c) for c in ("abcx", "abcz", "abcy", "diet")], "block string, candidate string")
    got = {r.text: (r.ratio, r.candidate) for r in resolve.best_match(texts, options, 0.1).collect()}
    assert got["abc"][1] == "abcz"
    assert got["tide"] == (difflib.SequenceMatcher(None, "diet", "tide").ratio(), "diet")
    with pytest.raises(ValueError, match="matcher"):
        resolve.best_match(texts, options, 0.1, "other")


def test_exact_keeps_other_spellings(spark, rows):
    data = [("1", "Apple", "PIXEL 8"), ("2", "", ""), ("3", "Nokia", "General"), ("4", None, "3310"), ("5", "x", "GALAXY s24")]
    df = spark.createDataFrame(data, "comment_id string, brand_name string, product_name string")
    assert rows(resolve.resolve_exact(df, reference(spark))) == [
        ("1", "apple", "Pixel 8"), ("2", "Unknown", "general"), ("3", "Nokia", "general"),
        ("4", "Unknown", "3310"), ("5", "x", "Galaxy S24"),
    ]


def test_brand_models(spark, rows):
    got = rows(resolve.brand_models(reference(spark)))
    assert got == sorted((b, m.lower()) for b, m in REFERENCE)
