import numpy as np
import pandas as pd
import pytest
from helpers import at, books, reviews, rows, sales, scores
from pyspark.sql import functions as F

from shelfrank.functions import scalars
from shelfrank.functions.scalars import clean_text
from shelfrank.operators import profiles, rerank


@pytest.fixture(scope="module")
def shelf(spark):
    return books(
        spark,
        [
            (1, "One", "Ann", "Sea", 4.25, 12345678),
            (2, "Two", "Bob", "Sky", 3.0, 0),
            (3, "Three", "Ann", "Sea", 0.0, 5),
            (4, "Four", "Cid", "Ice", 4.0, 5),
            (5, "Five", "Dot", "Oak", 4.0, 5),
        ],
    )


def test_profile_lines_and_their_order(spark, shelf):
    weights = scores(spark, [(1, 1, 2.0), (1, 2, 5.0), (1, 3, 2.0), (1, 4, 5.0), (1, 5, 1.0), (2, 2, 1.0), (9, 1, 1.0)])
    bought = sales(
        spark,
        [
            (1, 1, at(1), "completed"),
            (1, 2, at(3), "completed"),
            (1, 4, at(3), "completed"),
            (1, 5, at(9), "pending"),
            (1, 77, at(9), "completed"),
        ],
    )
    liked = reviews(spark, [(1, 1, 4.0, at(1)), (1, 2, 5.0, at(1)), (1, 3, 4.0, at(2)), (2, 1, 3.0, at(1))])
    users = spark.createDataFrame([(1,), (2,), (3,), (1,)], "user_id long")
    got = dict(rows(profiles.user_profiles(users, weights, bought, liked, shelf)))
    assert got[1] == (
        "User strongly prefers:\n"
        "- Categories: Ice, Sky, Sea\n"
        "- Authors: Bob, Cid, Ann\n"
        "- Highly rated books: Two, Three\n"
        "- Recently purchased: Two, Four"
    )
    assert got[2] == "User strongly prefers:\n- Categories: Sky\n- Authors: Bob"
    assert got[3] == "User strongly prefers:"
    assert set(got) == {1, 2, 3}


def test_description_text(shelf):
    got = dict(rows(profiles.item_descriptions(shelf)))
    assert got[1] == "Title: One\nAuthor: Ann\nCategory: Sea\nAverage Rating: 4.3\nPopularity rank: 12345678"
    assert got[3].endswith("Average Rating: 0.0\nPopularity rank: 5")


def test_missing_and_candidate_books(spark, shelf):
    wanted = spark.createDataFrame([(1,), (1,), (8,)], "book_id long")
    assert rows(profiles.missing_books(wanted, shelf)) == [(8,)]
    assert rows(profiles.candidate_books(shelf, wanted), "book_id") == [(1,)]


def test_clean_text(spark):
    df = spark.createDataFrame(
        [("  a\t\n b  ",), ("Café",), ("　",), ("",), (None,), ("x y",)], "t string"
    )
    got = [r[0] for r in df.select(clean_text(df["t"], "none")).collect()]
    assert got == ["a b", "Café", "none", "none", "none", "x y"]


def candidates(spark, triples):
    return spark.createDataFrame(triples, "user_id long, candidate_book_id long, mf_score double")


def test_rerank_drops_pairs_without_text_and_orders_ties(spark, shelf):
    texts = spark.createDataFrame(
        [(1, "User strongly prefers:\n- Authors: Ann"), (2, ""), (4, "nothing in common")],
        "user_id long, user_profile string",
    )
    liked = spark.createDataFrame([(1, "Sea")], "user_id long, category_name string")
    cands = candidates(
        spark,
        [(1, 2, 0.9), (1, 1, 0.1), (1, 77, 5.0), (2, 1, 1.0), (3, 1, 1.0), (4, 5, 0.2), (4, 4, 0.2), (4, 2, 0.3)],
    )
    got = rerank.rerank_candidates(
        cands, texts, profiles.item_descriptions(shelf), shelf, liked, top_k=2
    )
    assert rows(got, "user_id", "rank", "book_id") == [(1, 1, 1), (1, 2, 2), (4, 1, 4), (4, 2, 5)]
    scored = {(r["user_id"], r["book_id"]): r["semantic_score"] for r in got.collect()}
    # {user strongly prefers authors ann} and {title one author ann category sea average rating 4 3
    # popularity rank 12345678} share one word of seventeen.
    logit = 4 * 1 / 17 + 1 + 0.2 * 1.25 - 1
    assert scored[(1, 1)] == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-6)


def test_arrow_scorer_sees_batches_of_its_size(spark):
    pairs = spark.createDataFrame([("a b", f"b c{n}") for n in range(70)], "user_profile string, item_description string")

    def load():
        def score(profile: pd.Series, description: pd.Series) -> np.ndarray:
            return np.full(len(profile), float(len(profile)))

        return score

    got = {round(np.log(r["score"] / (1 - r["score"]))) for r in rerank.score_text_pairs(pairs.coalesce(1), load, 32).collect()}
    assert got == {32, 6}
    with pytest.raises(ValueError):
        rerank.score_text_pairs(pairs.drop("user_profile"), load)


def cut_one_by_one(a, b, budget):
    while len(a) + len(b) > budget:
        if len(a) > len(b):
            a = a[:-1]
        else:
            b = b[:-1]
    return a, b


def test_cut_lengths_are_those_of_cutting_one_by_one(spark):
    pairs = [(a, b, n) for n in range(9) for a in range(12) for b in range(12)]
    for a, b, n in pairs:
        x, y = cut_one_by_one([0] * a, [0] * b, n)
        assert [int(v[0]) for v in rerank.cut_lengths(np.array([a]), np.array([b]), n)] == [len(x), len(y)]
    df = spark.createDataFrame([(a, b) for a, b, n in pairs if n == 7], "a long, b long")
    for r in df.select("a", "b", *rerank.cut_length_columns(F.col("a"), F.col("b"), 7)).collect():
        x, y = cut_one_by_one([0] * r[0], [0] * r[1], 7)
        assert (r[2], r[3]) == (len(x), len(y))


@pytest.mark.parametrize(("max_length", "marks"), [(16, (7, 8, 9)), (512, (None, None, 9)), (5, (None, None, None))])
def test_token_pairs_are_cut_and_batched_by_length(spark, max_length, marks):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    r = np.random.default_rng(3)
    words = ["red", "river", "ünïcode", "of", "12", "antidisestablishment"]
    texts = [" ".join(r.choice(words, n)) for n in (0, 1, 3, 8, 20, 300)]
    data = [(a, b) for a in texts for b in texts if (a, b) != ("", "")] + [(None, "x"), (texts[1], None)]

    def load():
        def logits(ids, mask):
            assert ids.shape == mask.shape and ids.shape[1] <= max_length and (ids[mask == 0] == 0).all()
            assert len(ids) <= 8 and (np.diff(mask.sum(axis=1)) >= 0).all()
            # depends on every id and its place
            return np.log((ids * mask * np.arange(1, ids.shape[1] + 1)).sum(axis=1) % 997 + 1.0)

        return rerank.TokenPairs(path, logits, max_length, marks)

    df = spark.createDataFrame(data, "user_profile string, item_description string").coalesce(1)
    tokenizer, want = Tokenizer.from_file(path), {}
    for a, b in data:
        ids = [tokenizer.encode(x or "", add_special_tokens=False).ids for x in (a, b)]
        x, y = cut_one_by_one(*ids, max_length - sum(m is not None for m in marks))
        row = [*([marks[0]] if marks[0] else []), *x, *([marks[1]] if marks[1] else []), *y, *([marks[2]] if marks[2] else [])]
        value = sum(v * n for n, v in enumerate(row, 1)) % 997 + 1.0
        want[a, b] = value / (1 + value)
    got = {(q["user_profile"], q["item_description"]): q["score"] for q in rerank.score_text_pairs(df, load, 8).collect()}
    assert got == pytest.approx(want)


def test_word_overlap_agrees_with_the_native_score(spark):
    data = [("Red river, red!", "the RED  sea"), ("", ""), ("a b c", "a b c"), ("...", "x"), ("é1 a", "E1 é"), (None, "a")] * 20
    df = spark.createDataFrame(data, "user_profile string, item_description string")
    native = scalars.jaccard(*(scalars.tokens(F.coalesce(c, F.lit(""))) for c in ("user_profile", "item_description")))
    scored = rerank.score_text_pairs(df, rerank.word_overlap_scorer).withColumn("want", scalars.sigmoid(native * 4.0 - 1.0))
    assert all(r["score"] == pytest.approx(r["want"]) for r in scored.collect())


def test_model_rerank_uses_the_given_scorer(spark, shelf):
    texts = spark.createDataFrame([(1, "p")], "user_id long, user_profile string")

    def load():
        return lambda profile, description: description.str.len().to_numpy(dtype=float) / 100

    cands = candidates(spark, [(1, 1, 0.1), (1, 2, 0.9)])
    got = rerank.rerank_with_model(cands, texts, profiles.item_descriptions(shelf), shelf, load)
    assert rows(got, "rank", "book_id") == [(1, 1), (2, 2)]
