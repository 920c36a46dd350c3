"""Operators with shuffles: joins, models, archives and the pipeline."""

import gzip
import hashlib
import io
import json
import random
import zipfile

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from lexiloom.llm import common, jaccard_join, language_mixture, maxent_lm, warc_zip


def shingle_set(text, n=5):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute_components(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a][1] & sets[b][1])
            if both and 100 * both >= 75 * len(sets[a][1] | sets[b][1]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), least.get(find(k))) for k, (i, s) in enumerate(sets)), key=str)


@pytest.fixture(scope="module")
def near_copies():
    rng = random.Random(6)
    word = lambda: "w%d" % rng.randrange(400)
    passage = " ".join(word() for _ in range(30))
    rows = []
    for group in range(8):
        base = [word() for _ in range(rng.choice((6, 40, 90)))]
        for _ in range(rng.choice((1, 3, 12))):
            own = list(base)
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = word()
            rows.append((len(rows), " ".join(own) + (f" {passage}" if rng.random() < 0.5 else "")))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "One two"), (904, "one TWO"), (5, rows[5][1]), (None, rows[3][1])]
    return rows


def test_components_equal_brute_force(spark, near_copies):
    docs = spark.createDataFrame(near_copies, "doc_id long, text string").selectExpr("*", "'x' AS component", "1L AS n")
    got = [tuple(r) for r in jaccard_join.components(docs).collect()]
    assert sorted(got, key=str) == brute_components(near_copies)
    kept = jaccard_join.one_of_each(docs)
    wanted = {i for i, _, c in brute_components(near_copies) if i == c}
    assert {r.doc_id for r in kept.collect()} - {None} == wanted and kept.columns == docs.columns
    assert jaccard_join.components(docs.limit(0)).count() == 0


def test_rounds_without_the_pair_count_find_the_same(spark, near_copies, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PAIRS_PER_POSTING", -1)
    docs = spark.createDataFrame(near_copies, "doc_id long, text string")
    assert sorted(map(tuple, jaccard_join.components(docs).collect()), key=str) == brute_components(near_copies)


def test_all_pairs_alone_find_the_same(spark, near_copies, monkeypatch):
    monkeypatch.setattr(jaccard_join, "ROUNDS", 0)
    docs = spark.createDataFrame(near_copies, "doc_id long, text string")
    assert sorted(map(tuple, jaccard_join.components(docs).collect()), key=str) == brute_components(near_copies)


def test_few_pairs_of_unlinked_copies_are_compared(spark, monkeypatch):
    """Copies of one text with as many changes as 128 parities do not see: only pairs close to a link reach their sets."""
    rng = random.Random(3)
    base = ["w%d" % i for i in range(150)]
    rows = []
    for i in range(60):
        own = list(base)
        for at in rng.sample(range(0, 150, 5), 4):
            own[at] = "x%d" % rng.randrange(10_000)
        rows.append((i, " ".join(own)))
    compared, stored = [], jaccard_join._stored

    def counted(frame, name):
        out = stored(frame, name)
        if name == "pairs":
            compared.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "_stored", counted)
    monkeypatch.setattr(jaccard_join, "ROUNDS", 0)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard_join.components(docs).collect()), key=str) == brute_components(rows)
    sets = [shingle_set(t) for _, t in rows]
    links = sum(100 * len(a & b) >= 75 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    assert sum(compared) <= links + 0.05 * 60 * 59 / 2


def test_runs_take_four_bytes_a_token_and_lose_none(spark):
    tokens = np.sort(common.mix(np.arange(5_000, dtype=np.uint64)))
    for dropped in (0, 29, 32):
        runs = jaccard_join._token_runs([tokens, tokens[:7]], dropped).to_pydict()
        assert sum(map(len, runs["tokens"])) == 4 * 5_000 == sum(map(len, runs["counts"]))
        parts = [(np.uint64(at) << np.uint64(32)) | np.frombuffer(t, np.uint32) for at, t in zip(runs["at"], runs["tokens"])]
        assert (np.concatenate(parts) == tokens >> np.uint64(dropped)).all()
        assert sum(np.frombuffer(c, np.uint32).sum() for c in runs["counts"]) == 5_007


def test_word_hashes_do_not_depend_on_their_surroundings():
    long = b"x" * 10_000
    text = b"the cat " + long + b" the\tend " + b"y " * 600_000 + b"the cat"
    hashes, starts, ends = common.word_hashes(text)
    words = text.split()
    assert [text[a:b] for a, b in zip(starts[:5], ends[:5])] == words[:5]
    assert hashes[0] == hashes[3] == hashes[-2] and len(set(hashes.tolist())) == len(set(words)) and len(hashes) == len(words)


def test_languages(spark):
    texts = {"en": "the house and the garden with this water", "de": "das haus und der garten mit dem wasser", "ja": "日本語のテキストです"}
    rows = [(i, f"{t} {t.upper()}", lang) for i, (lang, t) in enumerate(list(texts.items()) * 5)]
    model = language_mixture.MixtureModel.fit(spark.createDataFrame(rows + [(50, None, "en"), (51, "x", None)], "doc_id long, text string, lang string"))
    asked = [(0, "und der garten"), (1, "with the water"), (2, "日本語"), (3, "12 !"), (4, ""), (5, None), (6, "the house and the garden with this water " * 3 + "das haus und der garten mit dem wasser " * 2)]
    docs = spark.createDataFrame(asked, "doc_id long, text string").selectExpr("*", "'z' AS score")
    out = {r.doc_id: r.language for r in language_mixture.with_language(docs, model).collect()}
    assert [out[i].lang_pred for i in range(6)] == ["de", "en", "ja", "und", "und", "und"]
    assert set(out[6].shares) == {"en", "de"} and 0.5 < out[6].shares["en"] < 0.7 and out[3].score == 0
    none = language_mixture.MixtureModel.fit(docs.limit(0).selectExpr("text", "text AS lang"))
    assert {r.language.lang_pred for r in language_mixture.with_language(docs, none).collect()} == {"und"}


def test_held_out_languages(spark, folder):
    out = entry.queries()["op3_language"](spark, folder)
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = out.filter("held_out").join(truth, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)


def test_class_chances_add_up():
    chances = maxent_lm.class_chances(np.random.default_rng(0).normal(size=maxent_lm.WEIGHTS))
    assert np.allclose(chances.sum(axis=1), 1)


def test_group_chances_add_up_and_fit():
    rng = np.random.default_rng(1)
    context, group = rng.integers(maxent_lm.CONTEXTS, size=5000), rng.integers(maxent_lm.GROUPS, size=5000)
    group = np.where(rng.random(5000) < 0.5, context // maxent_lm.SKIPPED % maxent_lm.GROUPS, group)
    counts = np.zeros((maxent_lm.CONTEXTS, maxent_lm.GROUPS))
    np.add.at(counts, (context, group), 1)
    split = counts.reshape(maxent_lm.PREVIOUS, maxent_lm.SKIPPED, maxent_lm.GROUPS)
    pairs = np.bincount(maxent_lm._pair(context, 3 * maxent_lm.GROUPS + group), minlength=maxent_lm.BOTH)
    chances, reached = maxent_lm.group_chances(3, counts.sum(axis=1), split.sum(axis=1), split.sum(axis=0), pairs)
    assert np.allclose(chances.sum(axis=1), 1)
    assert np.isclose(reached[0], -np.log10(maxent_lm.GROUPS)) and reached[-1] > reached[0] + 0.3


def test_words_of_a_class_depend_on_the_words_before(spark):
    rows = [(i, ("red cat", "blue bat")[i % 2]) for i in range(80)] + [(100, "red cat"), (101, "red bat"), (102, "blue cat"), (103, "blue bat")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = docs.doc_id >= 100
    cat, bat = maxent_lm.groups_of([b"cat", b"bat"])
    assert cat // maxent_lm.GROUPS == bat // maxent_lm.GROUPS and cat != bat
    model = maxent_lm.Model.fit(docs.filter(~held))
    assert (model.group_fit[cat // maxent_lm.GROUPS][1] > model.group_fit[cat // maxent_lm.GROUPS][0]).all()
    for sums in (10.0 ** model.log_group.astype(float)).reshape(-1, maxent_lm.CLASSES, maxent_lm.GROUPS).sum(axis=2).T[1:]:
        assert np.allclose(sums, 1, atol=1e-4)
    out = {r.doc_id: r for r in maxent_lm.score(docs, model, held).collect()}
    assert abs(out[100].base_score - out[101].base_score) < 1e-9
    assert out[100].score > out[101].score + 0.5 and out[103].score > out[102].score + 0.5


@pytest.mark.parametrize("hot", [0, 200_000])
def test_model_scores(spark, monkeypatch, hot):
    monkeypatch.setattr(maxent_lm, "HOT", hot)
    rows = [(i, t) for i, t in enumerate(["The cat sat", "the dog sat on the cat", "", None, "a cat sat"] * 4)] + [(90, "zebra cat cat"), (91, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = docs.doc_id >= 90
    model = maxent_lm.Model.fit(docs.filter(~held), steps=3)
    out = {r.doc_id: r for r in maxent_lm.score(docs, model, held).collect()}
    tokens = {i: [*(t or "").lower().split(), "\n"] for i, t in rows}
    seen = [w for i, t in tokens.items() if i < 90 for w in t]
    for i, own in tokens.items():
        base = sum(np.log10((seen.count(w) + 1) / (len(seen) + len(set(seen)) + 1)) for w in own)
        assert out[i].n_tokens == len(own) and out[i].n_known == sum(w in seen for w in own)
        assert abs(out[i].base_score - base) < 1e-9 and out[i].train_tokens == len(seen) and out[i].score < 0
    total = sum(out[i].score for i in tokens)
    assert total > sum(out[i].base_score for i in tokens)
    nothing = maxent_lm.Model.fit(docs.limit(0), steps=1)
    assert {r.n_known for r in maxent_lm.score(docs, nothing, held).collect()} == {0}


def test_archives_round_trip(spark):
    big = "<p>é " + "x" * 1200
    rows = [(1, "http://a/\n1", big), (2, None, big), (3, "u", "small"), (4, "u", "small"), (5, "u", None), (None, "n", big), (2, "again", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS size", "'d' AS digest")
    out = warc_zip.read(warc_zip.archive(spark, pages)).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in out) == [
        (0, "revisit", 2, 1206), (1, "revisit", 2, 1206), (2, "response", None, 1206), (2, "response", None, 1206),
        (3, "response", None, 5), (4, "response", None, 5), (5, "response", None, 0),
    ]
    assert {bytes(r.payload).decode() for r in out if r.page_id in (2, 3)} == {big, "small"}
    assert {r.url for r in out if r.page_id == 1} == {"http://a/%0A1"}
    assert warc_zip.read(warc_zip.archive(spark, pages.limit(0))).count() == 0


@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06 in a comment"])
@pytest.mark.parametrize("members", [2, 70_000])
def test_directory_of_foreign_archives(comment, members):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("packed", b"y" * 100, zipfile.ZIP_DEFLATED)
        for i in range(members):  # beyond 65,535 members the ZIP64 directory is needed
            with z.open(f"m{i}", "w", force_zip64=i == 1) as member:
                member.write(b"%d" % i)
        z.comment = comment
    file = pa.BufferReader(data.getvalue())
    found = warc_zip.directory(file, file.size())
    assert len(found) == members and "packed" not in found
    assert file.read_at(found["m1"][1], found["m1"][0]) == b"1"


def _foreign(folder, lines, name="other.wacz"):
    """An archive of another writer: two WARC members, one plain and one packed by record, and its index lines."""
    one = warc_zip.record(1, "http://a", b"first", 5, hashlib.sha1(b"first").hexdigest(), None)
    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    two = warc_zip.record(2, "http://b", b"second", 6, hashlib.sha1(b"second").hexdigest(), None).replace(b"urn:page:2", b"urn:uuid:ab")
    packed = gzip.compress(two)
    with zipfile.ZipFile(folder / name, "w") as z:
        z.writestr("archive/", b"")
        z.writestr("archive/a.warc", info + one)
        z.writestr("archive/b.warc.gz", packed)
        z.writestr("pages/pages.jsonl", b"{}", zipfile.ZIP_DEFLATED)
        places = {"INFO": (0, len(info)), "ONE": (len(info), len(one)), "TWO": (0, len(packed))}
        text = "!meta\n" + "".join(
            f"com,a)/ 2020 {json.dumps({'offset': places[k][0], 'length': str(places[k][1]), 'filename': f})}\n" for k, f in lines
        )
        z.writestr("indexes/pages.cdx", text)
    return str(folder / name)


def test_archives_of_other_writers(spark, tmp_path):
    uri = _foreign(tmp_path, [("INFO", "a.warc"), ("ONE", "a.warc"), ("TWO", "archive/b.warc.gz"), ("TWO", "b.warc.gz")])
    out = warc_zip.read(spark.createDataFrame([(uri,)], "uri string")).collect()
    assert sorted((r.page_id or 0, r.url, bytes(r.payload)) for r in out) == [(0, "http://b", b"second"), (1, "http://a", b"first")]
    wrong = _foreign(tmp_path, [("ONE", "c.warc")], "wrong.wacz")
    with pytest.raises(Exception, match="not stored"):
        warc_zip.read(spark.createDataFrame([(wrong,)], "uri string")).collect()
    with zipfile.ZipFile(tmp_path / "none.wacz", "w") as z:
        z.writestr("indexes/index.cdxj", "")
    with pytest.raises(Exception, match="no stored WARC member"):
        warc_zip.read(spark.createDataFrame([(str(tmp_path / "none.wacz"),)], "uri string")).collect()


def test_pipeline_stages(spark, folder):
    docs = common.table(spark, folder, "documents")
    rows = corpus_pipeline.run(spark, folder)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0 < rows.count() <= docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(30), folder).columns == docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near duplicates", "benchmark", "personal data", "encoding"]


@pytest.mark.parametrize("name", ["op2_decontamination", "op4_warc", "op7_hosts"])
def test_oracles(spark, folder, name):
    import check

    assert check.compare(spark, check.connect(folder), name, folder) == ""
