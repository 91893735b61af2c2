from __future__ import annotations

import zlib

from loomtext.llm import queries, toxicity


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_the_automaton_finds_one_edit():
    terms = ["idiot", "moron", "worthless", "scum", "lowei*"]
    trie = toxicity.LexiconTrie(terms)
    letters = "idotmrnwhlesxü"
    for term in ("idiot", "moron", "worthless"):
        near = {term[:i] + c + term[i + k :] for i in range(len(term) + 1) for c in ["", *letters] for k in (0, 1)}
        for word in near:
            wanted = {t: edits(word, t) for t in terms[:3] if edits(word, t) <= 1}
            assert trie.find(word) == wanted, word
    assert trie.find("loweischaft") == {"lowei*": 0}
    assert trie.find("scun") == {} and trie.find("scum") == {"scum": 0}


def test_quotation_counts_less():
    matcher = toxicity.Matcher({"idiot": 5.0, "scum": 5.0})
    plain = toxicity.features("you are an idiot and scum of the worst kind here", matcher)
    quoted = toxicity.features('a report said that "idiot" and "scum" are words of the street', matcher)
    assert plain[0] > quoted[0] and plain[4] == 0 < quoted[4]
    assert toxicity.features("", matcher) == [0.0] * toxicity.FEATURES


def test_odd_rows_and_missing_labels(spark):
    docs = spark.createDataFrame(
        [(1, None, 1.0), (None, "x", 2.0), (2, "", 3.0), (2, "y " * 100_000, 4.0)], "doc_id long, text string, score double"
    )
    none = spark.createDataFrame([], "doc_id long, toxic int")
    odd = spark.createDataFrame([(None, 1), (2, None), (2, 7)], "doc_id long, toxic int")
    for labels in (none, odd):
        model = toxicity.fit_toxicity(docs, labels)
        got = toxicity.score_toxicity(docs, model).collect()
        assert len(got) == 4 and all(0 <= r.score < 0.7 and r.predicted == 0 for r in got)
        assert toxicity.drop_toxic(docs, model).columns == docs.columns
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = dict(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic").collect())
    got = queries.op2_toxicity(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(r.predicted == (r.score >= 0.7) for r in got)
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    assert not any(p for y, p in held if y == 0)
    assert sum(p for y, p in held if y == 1) >= 0.6 * sum(y for y, _ in held)


def test_misspelled_words_of_a_taken_stem_are_found(spark):
    # Every toxic text has a word and its stems equally often, so a stem is taken first.
    terms = ["idiot", "trash", "moron", "pathetic", "worthless"]
    plain = ["oron", "worthy", "worth", "forth", "worthing", "orthly", "path", "table", "river", "green"]
    said = "the {} of {} is here today".format
    rows = [(i, said(terms[i % 5], terms[(i + 1) % 5]) + f" {i}", 1) for i in range(200)]
    rows += [(1000 + i, said(plain[i % 10], plain[(i + 3) % 10]) + f" {i}", 0) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit_toxicity(docs, docs)
    misspelled = ["ldiot", "tr4sh", "mron", "pethetic", "w0rthless", "worthles", "ldiotic"]
    texts = [(i, said(w, w)) for i, w in enumerate(misspelled)]
    texts += [(50 + i, said(w, w)) for i, w in enumerate(plain)]
    got = toxicity.score_toxicity(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()
    assert {r.doc_id for r in got if r.predicted} == set(range(len(misspelled)))


def test_stems_within_one_edit():
    trie = toxicity.LexiconTrie(["idiot*", "pathet*", "trash*", "scum*"], frozenset(["trash*"]))
    letters = "idotpahexü"
    for stem in ("idiot", "pathet"):
        near = {stem[:i] + c + stem[i + k :] for i in range(len(stem) + 1) for c in ["", *letters] for k in (0, 1)}
        for word in {n + end for n in near for end in ("", "s", "ically")}:
            least = min(edits(word[:n], stem) for n in range(len(word) + 1))
            assert trie.find(word) == {f"{stem}*": least}, word
    assert trie.find("trashes") == {"trash*": 0} and trie.find("tr4shes") == {}
    assert trie.find("scums") == {"scum*": 0} and trie.find("scvms") == {}
