"""Language identification, pseudo-likelihood and token rollups."""

from __future__ import annotations

import random
import re
from types import SimpleNamespace

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillmart.llm import language, pseudo_likelihood, token_rollup
from tillmart.llm.common import shared_folder

# --- language ------------------------------------------------------------------------

STEMS = {
    "aa": ["kal", "mor", "tin", "bek", "lus", "oro"],
    "bb": ["gra", "pez", "dun", "wix", "hol", "sab"],
    "cc": ["éla", "çun", "îto", "ñar", "üso", "ôpe"],
}


def sentence(draw, lang, words):
    return " ".join("".join(draw.choices(STEMS[lang], k=draw.randint(1, 3))) for _ in range(words)) + "."


def labelled(draw, count):
    rows = []
    for n in range(count):
        lang = draw.choice(list(STEMS))
        rows.append((n, sentence(draw, lang, draw.randint(4, 40)), lang, "s", n))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, score long"


@pytest.fixture(scope="module")
def model(spark):
    return language.learn(spark.createDataFrame(labelled(random.Random(1), 300), SCHEMA))


def test_unseen_texts_get_their_language(spark, model):
    rows = labelled(random.Random(2), 200)
    hidden = [(n, text, None, None, k) for n, text, _, _, k in rows]
    found = language.identify(spark.createDataFrame(hidden, SCHEMA), model)
    assert found.columns == ["doc_id", "text", "lang", "source", "lang_pred", "score", "n_words", "doubt"]
    by_id = {r.doc_id: r for r in found.collect()}
    right = sum(by_id[n].lang_pred == lang for n, _, lang, _, _ in rows)
    assert right >= 198
    assert all(0 < r.score <= 1 for r in by_id.values())


def test_a_word_is_looked_up_before_its_groups(model):
    word = next(iter(model.words))
    assert model.rows_of_word(word) == [model.words[word]]
    rows = model.rows_of_word(word + word + "q")
    assert all(row >= len(model.words) for row in rows) and len(rows) > 1


def test_tasks_are_sent_the_same_model(model):
    import pickle

    sent = pickle.loads(pickle.dumps(model))
    again = pickle.loads(pickle.dumps(sent))
    words = [*list(model.words)[:50], "kalmorq", "zzz", "élaé"]
    for other in (sent, again):
        assert [other.rows_of_word(w) for w in words] == [model.rows_of_word(w) for w in words]
        found, wanted = (language.predict(m, [" ".join(words), "kal"]) for m in (other, model))
        assert found[0] == wanted[0] and np.allclose(found[1], wanted[1])


def test_longest_known_groups_are_taken_from_left_to_right():
    groups = {"ab": 0, "a": 1, "c": 2, language.EDGE: 3, "abc": 4}
    scores = np.zeros((5, 1))
    bare = language.Model(["x"], np.zeros(1), {"known": 0}, groups, np.zeros((1, 1)), scores, np.zeros(1))
    assert bare.rows_of_word("abcab") == [1 + g for g in (3, 4, 0, 3)]
    assert bare.rows_of_word("zc") == [1 + 3, 1 + 5, 1 + 2, 1 + 3]


def test_scores_are_sums_over_words(model):
    names, scores, counts = language.predict(model, ["kalmor grapez kal", "kalmor", "grapez kal"])
    table, sums = model.table(), []
    for text in ("kalmor grapez kal", "kalmor", "grapez kal"):
        rows = [row for word in text.split() for row in model.rows_of_word(word)]
        total = table[rows].sum(axis=0) + model.prior
        sums.append(np.exp(total - total.max()) / np.exp(total - total.max()).sum())
    assert np.allclose(scores, [s.max() for s in sums])
    assert names == [model.languages[s.argmax()] for s in sums] and counts.tolist() == [3, 1, 2]


def test_texts_without_letters_and_odd_rows(spark, model):
    long = sentence(random.Random(5), "bb", 200_000)
    rows = [(1, None), (2, ""), (3, " 12 !?"), (4, "kal"), (4, "kal"), (None, "中文"), (5, long)]
    found = language.identify(spark.createDataFrame([(*r, None, None, 0) for r in rows], SCHEMA), model)
    by_id = {}
    for r in found.collect():
        by_id.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert by_id[1] == by_id[2] == by_id[3] == [("und", 0.0)]
    assert len(by_id[4]) == 2 and by_id[4][0] == by_id[4][1]
    assert by_id[None][0][0] in STEMS and by_id[5][0][0] == "bb"
    assert found.limit(0).count() == 0


def test_nothing_to_learn_from(spark):
    given = spark.createDataFrame([(1, "some text", None, "s", 1)], SCHEMA)
    empty = language.learn(given)
    assert empty.languages == []
    row = language.identify(given, empty).first()
    assert (row.lang_pred, row.score) == ("und", 0.0)
    assert language.identify(given.limit(0), language.learn(given.limit(0))).count() == 0


def test_held_out_rows(spark):
    import zlib

    given = spark.createDataFrame([(n,) for n in range(200)] + [(None,)], "doc_id long")
    for row in given.select("doc_id", language.held_out().alias("held")).collect():
        assert row.held == (zlib.crc32(str(row.doc_id if row.doc_id is not None else "").encode()) % 4 == 2)


def test_sample_is_bounded_and_its_labels_alone_count(spark):
    rows = labelled(random.Random(3), 200) + [(1000 + n, "zzz", "dd", "s", 0) for n in range(50)]
    given = spark.createDataFrame(rows, SCHEMA)
    taught = language.learn(given, F.col("lang") != "dd")
    assert "dd" not in taught.languages and "zzz" not in taught.words
    few = language.learn(given, training_rows=20)
    assert 0 < len(few.words) < len(taught.words)


def test_a_rare_language_keeps_its_words_and_groups(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_WORDS", 120)
    monkeypatch.setattr(language, "MOST_GROUPS", 300)
    draw = random.Random(6)
    rows = [(n, sentence(draw, "aa", 40), "aa", "s", 0) for n in range(300)]
    rows += [(1000 + n, sentence(draw, "cc", 6), "cc", "s", 0) for n in range(6)]
    rows += [(2000, "!!", "bb", "s", 0)]  # a language without a word is one as well
    taught = language.learn(spark.createDataFrame(rows, SCHEMA))
    assert taught.languages == ["aa", "bb", "cc"]
    assert len(taught.words) <= 120 and len(taught.groups) <= 300
    own = {w for _, text, lang, _, _ in rows if lang == "cc" for w in text.rstrip(".").split()}
    assert len(own & set(taught.words)) >= 10
    names, _, _ = language.predict(taught, [sentence(draw, "cc", 8), sentence(draw, "aa", 8)])
    assert names == ["cc", "aa"]


def test_learned_counts_against_plain_python(spark):
    from collections import Counter

    rows = labelled(random.Random(9), 60)
    taught = language.learn(spark.createDataFrame(rows, SCHEMA))
    langs = sorted({r[2] for r in rows})
    words = {lang: Counter() for lang in langs}
    for _, text, lang, _, _ in rows:
        words[lang].update(w for w in re.split(r"[\W\d_]+", text.lower()) if w)
    groups = {lang: Counter() for lang in langs}
    for lang, told in words.items():
        for word, n in told.items():
            marked = f"{language.EDGE}{word}{language.EDGE}"
            for size in range(1, language.LONGEST + 1):
                for at in range(len(marked) - size + 1):
                    groups[lang][marked[at : at + size]] += n
    assert taught.languages == langs
    assert set(taught.words) == set().union(*words.values())
    assert set(taught.groups) == set().union(*groups.values())
    totals = [sum(words[lang].values()) for lang in langs]
    for word, row in taught.words.items():
        wanted = [np.log((words[g][word] + 0.1) / (t + 0.1 * len(taught.words))) for g, t in zip(langs, totals)]
        assert np.allclose(taught.word_scores[row], wanted)
    for group, row in taught.groups.items():
        size, same = len(group), [g for g in taught.groups if len(g) == len(group)]
        level = (language.LONGEST - size + 1) * np.log(language.BACKOFF)
        wanted = [
            np.log((groups[g][group] + 0.1) / (sum(groups[g][x] for x in same) + 0.1 * len(same))) + level
            for g in langs
        ]
        assert np.allclose(taught.group_scores[row], wanted)


# --- pseudo-likelihood ------------------------------------------------------------------


def texts_with_order(draw, count):
    """Words come in pairs, so each tells much of its neighbours."""
    pairs = [("red", "apple"), ("blue", "sky"), ("green", "grass"), ("warm", "sun"), ("cold", "rain")]
    return [" ".join(w for p in draw.choices(pairs, k=40) for w in p) for _ in range(count)]


@pytest.fixture(scope="module")
def trained(spark):
    texts = texts_with_order(random.Random(1), 4000)
    given = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    words = pseudo_likelihood.vocabulary(given)
    return words, pseudo_likelihood.train(given, words, stride=1)


def test_words_around_help(trained):
    words, network = trained
    texts = texts_with_order(random.Random(2), 50)
    count, total = pseudo_likelihood.score(words, network, texts)
    start, before = pseudo_likelihood.score(words, pseudo_likelihood.Network.start(words.log_classes), texts)
    assert (count == 80).all() and (start == count).all()
    # Ten words by themselves have a mean of log(1/10) at best.
    assert total.sum() / count.sum() > np.log(1 / 10) + 0.7
    assert total.sum() > before.sum() + 50
    shuffled = [" ".join(random.Random(3).sample(t.split(), 80)) for t in texts]
    assert pseudo_likelihood.score(words, network, shuffled)[1].sum() < total.sum() - 1000


def test_every_word_is_a_training_target(spark, trained, monkeypatch):
    words, network = trained
    texts = texts_with_order(random.Random(4), 30) + ["red", "strange sky", ""]
    targets = []
    monkeypatch.setattr(pseudo_likelihood.Trainer, "step", lambda self, around, classes, *_: targets.extend(classes))
    shared = SimpleNamespace(value=(words, network))
    batches = [pd.DataFrame({"text": texts[:20]}), pd.DataFrame({"text": texts[20:]})]
    learned = list(pseudo_likelihood._train_task(batches, shared, pseudo_likelihood.STRIDE))
    wanted = [words.look_up(found)[1] for _, found in pseudo_likelihood._word_hashes(texts)]
    assert sorted(targets) == sorted(np.concatenate(wanted)) and learned[0]["seen"][0] == len(targets) == 30 * 80 + 3


def test_words_around_help_with_the_parameters_of_the_query(spark):
    texts = texts_with_order(random.Random(1), 500)
    shuffled = [" ".join(random.Random(n).sample(t.split(), 80)) for n, t in enumerate(texts[:50])]
    given = spark.createDataFrame(list(enumerate(texts + shuffled)), "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.mean_log_likelihood for r in pseudo_likelihood.score_documents(given).collect()}
    ordered, mixed = (np.mean([found[n + k] for n in range(50)]) for k in (0, 500))
    assert ordered > np.log(1 / 10) + 0.7 and mixed < ordered - 0.5


def test_chances_of_all_words_sum_to_one(trained):
    words, network = trained
    around = np.full((1, 4), 3)
    classes = [network.log_chances(around, np.array([k]))[0] for k in range(pseudo_likelihood.CLASSES)]
    assert abs(np.exp(classes).sum() - 1) < 1e-5
    in_class = np.zeros(pseudo_likelihood.CLASSES)
    np.add.at(in_class, words.classes, np.exp(words.log_in_class))
    assert np.allclose(in_class[np.unique(words.classes)], 1)


def hashes(words):
    ((_, found),) = pseudo_likelihood._word_hashes([" ".join(words)])
    return found


def test_words_around_tell_words_of_one_class_apart(spark):
    names = ["".join(random.Random(n).choices("abcdefghij", k=6)) for n in range(400)]
    common, rarer = names[:60], names[60:]
    shared = pseudo_likelihood._shared_class(hashes(rarer))
    x, y = (rarer[n] for n in np.flatnonzero(shared == shared[0])[:2])
    draw, texts = random.Random(5), []
    for _ in range(2000):
        text = draw.choices(common, k=60) + [draw.choice(rarer)]
        texts.append(" ".join([*text, common[0], x, common[0], *text[::-1], common[1], y, common[1]]))
    given = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    words = pseudo_likelihood.vocabulary(given)
    assert set(words.look_up(hashes([x, y]))[1]) == {shared[0]}
    network = pseudo_likelihood.train(given, words)
    tried = [f"{common[0]} {x} {common[0]}", f"{common[0]} {y} {common[0]}",
             f"{common[1]} {x} {common[1]}", f"{common[1]} {y} {common[1]}"]
    _, (ax, ay, bx, by) = pseudo_likelihood.score(words, network, tried)
    assert (ax - ay) - (bx - by) > 2


def test_huffman_paths():
    draw = np.random.default_rng(3)
    counts = draw.integers(1, 1000, 500).astype(float) ** 2
    classes = pseudo_likelihood.OWN_CLASSES + draw.integers(0, 2, 500)
    classes[:5] = np.arange(5)
    rest = np.zeros(pseudo_likelihood.SHARED_CLASSES)
    rest[:2] = 12_345.0, 0.0
    paths = pseudo_likelihood.fork_paths(classes, counts, rest)
    forks = paths.forks(np.arange(500 + 2))
    sides = np.where(forks.bits, 1, -1) * forks.odds
    found = dict(zip(forks.places, np.add.reduceat(-np.log1p(np.exp(-sides)), forks.first[:-1])))
    assert not set(found) & set(range(5))
    for number in (0, 1):
        members = np.flatnonzero(classes == pseudo_likelihood.OWN_CLASSES + number)
        weights = dict(zip(members, counts[members])) | ({500: rest[0]} if number == 0 else {})
        total = sum(weights.values())
        for leaf, weight in weights.items():
            assert abs(found[leaf] - np.log(weight / total)) < 1e-4
        lengths = dict(zip(forks.places, np.diff(forks.first)))
        mean = sum(lengths[k] * w for k, w in weights.items()) / total
        entropy = -sum(w / total * np.log2(w / total) for w in weights.values())
        assert entropy <= mean < entropy + 1


def test_forks_below_the_heaviest_are_left_to_the_counts(monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "FORK_ROWS", 10)
    counts = np.arange(1.0, 201)
    classes = np.full(200, pseudo_likelihood.OWN_CLASSES)
    paths = pseudo_likelihood.fork_paths(classes, counts, np.zeros(pseudo_likelihood.SHARED_CLASSES))
    assert len(paths.odds) == 10 and paths.rows.max() == 9
    assert np.diff(paths.first).max() < 10 and np.isfinite(paths.odds).all()


def test_scores_do_not_depend_on_how_rows_are_stored(spark, monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "SHARD_WORDS", 4000)
    texts = texts_with_order(random.Random(4), 200)
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = []
    for rows in (given.coalesce(1), given.repartition(16), given.orderBy("text").coalesce(2)):
        scored = pseudo_likelihood.score_documents(rows).collect()
        found.append([r.log_likelihood for r in sorted(scored, key=lambda r: r.doc_id)])
    assert np.allclose(found[0], found[1], rtol=1e-5) and np.allclose(found[0], found[2], rtol=1e-5)


def test_chances_inside_a_class_sum_to_one_in_any_context(spark):
    names = ["".join(random.Random(n).choices("abcdefghij", k=6)) for n in range(500)]
    text = " ".join(" ".join([name] * (1 + n % 7)) for n, name in enumerate(names))
    words = pseudo_likelihood.vocabulary(spark.createDataFrame([(text,)], "text string"))
    network = pseudo_likelihood.Network.start(words.log_classes)
    network.forks[:] = np.random.default_rng(1).standard_normal(network.forks.shape)
    found = hashes(sorted(set(names)))
    _, classes, logs, leaves = words.known(found)
    around = np.full((len(found), 4), 3)
    forks = words.paths.forks(leaves)
    inside = network.log_chances(around, classes, forks) - network.log_chances(around, classes)
    assert np.abs(inside).max() > 0.5
    sums = np.bincount(classes, np.exp(logs + inside), pseudo_likelihood.CLASSES)
    assert np.allclose(sums[np.unique(classes)], 1, atol=1e-4)
    total = pseudo_likelihood.score(words, network, [names[300]])[1][0]
    edge = np.full((1, 4), pseudo_likelihood.EDGE_INPUT)
    one = found == hashes([names[300]])
    alone = network.log_chances(edge, classes[one], words.paths.forks(leaves[one])) + logs[one]
    assert abs(total - alone[0]) < 1e-4


def test_counts_of_rare_words_do_not_depend_on_the_size_of_the_vocabulary(spark, monkeypatch):
    names = ["".join(random.Random(n).choices("abcdefghij", k=6)) for n in range(600)]
    draw = random.Random(8)
    rows = [(n % 90, " ".join(draw.choices(names, range(1, 601), k=40))) for n in range(100)]
    rows += [(None, "only once here"), (3, None), (4, " ")]
    given = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)

    def found():
        got = pseudo_likelihood.score_documents(given).collect()
        return sorted((str(r.doc_id), r.n_words, r.log_likelihood, r.mean_log_likelihood or 0) for r in got)

    # Without weights from the class on, only counts tell words apart.
    def untrained(texts, words):
        network = pseudo_likelihood.Network.start(words.log_classes)
        network.out[:] = 0
        return network

    monkeypatch.setattr(pseudo_likelihood, "train", untrained)
    whole = found()
    monkeypatch.setattr(pseudo_likelihood, "MOST_WORDS", 300)
    held = pseudo_likelihood.vocabulary(given.select("text"))
    assert len(held.hashes) <= 300 and np.isnan(held.rest_log_in_class).any()
    cut = found()
    assert len(cut) == len(rows) and [r[:2] for r in cut] == [r[:2] for r in whole]
    assert np.allclose([r[2:] for r in cut], [r[2:] for r in whole], atol=1e-3)


def test_score_is_the_sum_over_places(trained):
    words, network = trained
    text = "red apple strange sky"
    count, total = pseudo_likelihood.score(words, network, [text])
    ((owners, found),) = pseudo_likelihood._word_hashes([text])
    inputs, classes, logs = words.look_up(found)
    edge = pseudo_likelihood.EDGE_INPUT
    padded = [edge, edge, *inputs, edge, edge]
    wanted = 0.0
    for place in range(4):
        around = np.array([[padded[place], padded[place + 1], padded[place + 3], padded[place + 4]]])
        wanted += network.log_chances(around, classes[place : place + 1])[0] + logs[place]
    assert count[0] == 4 and abs(total[0] - wanted) < 1e-4


def test_gradient_of_a_step():
    draw = np.random.default_rng(1)
    net = pseudo_likelihood.Network.start(np.zeros(pseudo_likelihood.CLASSES))
    around = draw.integers(0, 50, (30, 4))
    classes = draw.integers(0, pseudo_likelihood.CLASSES, 30)
    before = net.log_chances(around, classes).mean()
    trainer = pseudo_likelihood.Trainer(net)
    for _ in range(30):
        trainer.step(around, classes)
    assert net.log_chances(around, classes).mean() > before + 0.5


def test_odd_documents(spark):
    rows = [(1, None), (2, " \n"), (3, "red apple"), (3, "red apple"), (None, "sky"), (4, "sun " * 300_000)]
    given = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")
    found = sorted(pseudo_likelihood.score_documents(given).collect(), key=lambda r: str(r.doc_id))
    by_id = {r.doc_id: r for r in found}
    assert len(found) == 6 and by_id[4].n_words == 300_000
    assert by_id[1][1:] == (0, 0.0, None) and by_id[2][1:] == (0, 0.0, None)
    assert by_id[3].log_likelihood < 0 and abs(by_id[3].mean_log_likelihood * 2 - by_id[3].log_likelihood) < 1e-9
    assert pseudo_likelihood.score_documents(given.limit(0)).count() == 0


# --- token rollups ----------------------------------------------------------------------

PATH = public_tokenizers.path("word_bpe_49k.json")


def counted(spark, rows):
    given = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, source string, lang string, tokens int")
    return token_rollup.token_counts(given, PATH, "v1")


def test_counts_are_the_library_s(spark):
    library = Tokenizer.from_file(PATH)
    texts = ["The cat's 12 mats", None, "", "x " * 100_000, "é 中"]
    rows = [(n, t, "s", None) for n, t in enumerate(texts)] + [(None, "a", None, "en")] * 2
    found = counted(spark, rows).collect()
    assert len(found) == 7
    for row in found:
        text = "a" if row.doc_id is None else texts[row.doc_id] or ""
        assert row.tokens == len(library.encode(text, add_special_tokens=False).ids)
        assert row.chars == len(text) and row.tokenizer == "v1"
    assert counted(spark, []).count() == 0


def totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens, r.chars) for r in rollup.totals().collect()}


def brute(held):
    found = {}
    for source, lang, tokenizer, tokens, chars in held.values():
        key = (source, lang, tokenizer)
        old = found.get(key, (0, 0, 0))
        found[key] = (old[0] + 1, old[1] + tokens, old[2] + chars)
    return found


def test_rollups_follow_inserts_deletes_and_revisions(spark):
    draw = random.Random(6)
    rollup = token_rollup.TokenRollup(spark, shared_folder(spark, "rollup"))
    assert totals(rollup) == {}
    held, schema = {}, token_rollup.COUNTS

    def frame(keys, rows):
        return spark.createDataFrame([(k, *rows[k]) for k in keys], schema)

    def new():
        return (draw.choice(["a", "b", None]), draw.choice(["x", None]), draw.choice(["v1", "v2"]),
                draw.randrange(50), draw.randrange(90))

    for batch in range(6):
        fresh = {1000 * batch + n: new() for n in range(draw.randrange(20))}
        gone = draw.sample(sorted(held), min(len(held), 5))
        changed = draw.sample(sorted(set(held) - set(gone)), min(len(held) - len(gone), 4))
        after = {k: new() for k in changed}
        changes = token_rollup.inserted(frame(fresh, fresh)).unionByName(token_rollup.deleted(frame(gone, held)))
        changes = changes.unionByName(token_rollup.revised(frame(changed, held), frame(changed, after)))
        assert rollup.commit(f"b{batch}", changes)
        assert not rollup.commit(f"b{batch}", changes)
        for key in gone:
            del held[key]
        held |= fresh | after
        assert totals(rollup) == brute(held)
        if batch in (2, 4):
            rollup.merge()
            assert totals(rollup) == brute(held)
            assert not rollup.commit(f"b{batch}", changes)
    assert rollup.batches() == [f"b{n}" for n in range(6)]
    everything = frame(sorted(held), held)
    for merged in ("b0", "b3"):
        rollup._fs().delete(rollup._path(merged), True)
    assert totals(rollup) == brute(held) and "b0" in rollup.batches()
    rollup._fs().delete(rollup._path(token_rollup.SNAPSHOTS, "00000001", "_SUCCESS"), False)
    assert rollup.batches() == [f"b{n}" for n in (0, 1, 2, 4, 5)]  # an unfinished snapshot
    rollup._fs().create(rollup._path(token_rollup.SNAPSHOTS, "00000001", "_SUCCESS")).close()
    rollup.commit("end", token_rollup.deleted(everything))
    assert totals(rollup) == {}


def test_a_batch_that_broke_off_counts_only_when_written_anew(spark):
    folder = shared_folder(spark, "rollup")
    rollup = token_rollup.TokenRollup(spark, folder)
    changes = token_rollup.inserted(counted(spark, [(1, "a b", "s", "en")]))
    changes.groupBy(*token_rollup.KEYS).agg(
        *[F.sum(c).alias(c) for c in ("docs", "tokens", "chars")]
    ).write.parquet(f"{folder}/one")
    fs, path = rollup._fs(), rollup._path("one", "_SUCCESS")
    fs.delete(path, False)
    assert totals(rollup) == {}
    assert rollup.commit("one", changes)
    assert totals(rollup) == {("s", "en", "v1"): (1, 2, 3)}
    with pytest.raises(ValueError):
        rollup.commit("../other", changes)


def test_products_start_no_threads():
    """Blocks are below the size from which OpenBLAS deals a product to threads, which wait busily."""
    p = pseudo_likelihood
    assert p.BLAS_ROWS * p.HIDDEN * p.CLASSES <= 4 * 65536
    draw = np.random.default_rng(4)
    for count in (0, 1, p.BLAS_ROWS, 2 * p.BLAS_ROWS + 3):
        a, b = draw.standard_normal((count, p.HIDDEN)), draw.standard_normal((count, p.CLASSES))
        out = draw.standard_normal((p.HIDDEN, p.CLASSES))
        assert p._in_blocks(a).shape[1] == p.BLAS_ROWS
        assert np.allclose(p._times(a, out), a @ out) and np.allclose(p._across(a, b), a.T @ b)
