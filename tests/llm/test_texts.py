import json
import math
import os
import random

import numpy as np
import pytest

from peakloom.llm import encodings, leakage, notebook, packing
from peakloom.llm.located import HALF, Located, pieces

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def check_packing(rows, sizes, capacity):
    containers, pieces = {}, {}
    for r in rows:
        containers.setdefault(r.container, []).append((r["at"], r.size))
        pieces.setdefault(r.key, []).append((r.piece, r.size))
    for held in containers.values():
        at = 0
        for start, size in sorted(held):
            assert start == at
            at += size
        assert at <= capacity
    assert sorted(pieces, key=str) == sorted(sizes, key=str)
    for k, own in pieces.items():
        own.sort()
        assert sum(s for _, s in own) == max(0, sizes[k] or 0) and [p for p, _ in own] == list(range(len(own)))
        assert len(own) == max(1, math.ceil(max(0, sizes[k] or 0) / capacity))
    return len(containers)


@pytest.mark.parametrize("partitions", [1, 4, 40])
def test_packing(spark, partitions):
    rng = random.Random(partitions)
    sizes = {k: rng.choice([0, 1, rng.randrange(1, 100), rng.randrange(1, 1000), 100, 250]) for k in range(1500)} | {None: 7, -5: -1, 9999: None}
    df = spark.createDataFrame(list(sizes.items()), "key bigint, size bigint")
    rows = packing.packed(df, 100, partitions=partitions).collect()
    used = check_packing(rows, sizes, 100)
    assert used <= 1.02 * math.ceil(sum(max(0, s or 0) for s in sizes.values()) / 100) + 2
    assert sorted(map(tuple, packing.packed(df, 100, partitions=partitions).collect()), key=str) == sorted(map(tuple, rows), key=str)
    assert packing.packed(df.where("false"), 100).count() == 0


@pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary here")
def test_token_counts(spark):
    import tiktoken  # noqa: F401

    rows = [(1, "Hello world, hello!"), (2, ""), (3, None), (4, "a " * 50_000), (4, "x")]
    got = packing.token_counts(spark.createDataFrame(rows, "key bigint, text string"), "key", "text", VOCABULARY).collect()
    assert sorted((r.key, r.size) for r in got if r.key != 4) == [(1, 5), (2, 0), (3, 0)] and sorted(r.size for r in got if r.key == 4)[0] == 1


def test_suffix_array_and_wavelet_matrix():
    rng = np.random.default_rng(1)
    for size, n in ((2, 200), (40, 500), (3, 1)):
        seq = np.concatenate([rng.integers(1, size, n), np.tile(rng.integers(1, size, 7), 9), [0]])
        order = leakage.suffixes(seq)
        assert order.tolist() == sorted(range(len(seq)), key=lambda k: seq[k:].tolist())
        w = leakage.WaveletMatrix(seq, size)
        at = np.arange(len(seq))
        assert w.symbol(at).tolist() == seq.tolist()
        for c in range(size):
            assert w.rank(np.full(len(seq) + 1, c), np.arange(len(seq) + 1)).tolist() == [0, *np.cumsum(seq == c)]


def test_index_finds_all_places():
    rng = np.random.default_rng(3)
    seq = rng.integers(1, 5, 2000)
    index = leakage.FmIndex(seq, 5)
    phrases = np.array([seq[k : k + 6] for k in range(0, 1900, 37)] + [[1] * 6])
    low, high = index.search(phrases)
    for p, a, b in zip(phrases, low, high):
        want = [k for k in range(len(seq) - 5) if (seq[k : k + 6] == p).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def brute_leaks(docs, items, length):
    out = set()
    for d, text, layout in docs:
        for cell in notebook.cells(text, layout) if text else []:
            grams = {tuple(ws[k : k + length]) for ws in [leakage.words(cell)] for k in range(len(ws) - length + 1)}
            for i, t in items:
                ws = leakage.words(t or "")
                if any(tuple(ws[k : k + length]) in grams for k in range(len(ws) - length + 1)):
                    out.add((i, d))
    return out


def test_leaks_match_brute_force(spark):
    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(12)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, say(rng.choice([3, 8, 30]))) for k in range(30)] + [(90, None), (91, "")]
    items.append((92, items[5][1]))
    docs = []
    for k in range(120):
        part = rng.choice(items[:30])[1].split()
        a = rng.randrange(len(part))
        body = f"{say(20)}\n# \"{' '.join(part[a : a + rng.randrange(1, 20)]).upper()}\"\n{say(5)} é {say(9)}"
        book = {"cells": [{"source": body.splitlines(True), "outputs": [{"text": say(6)}, {"data": {"text/plain": [say(7)]}}, {"traceback": [say(8), say(4)]}]}, {"source": body}]}
        docs += rng.choice([[(k, f"Text:\n{body}\n\nIn [1]:\n{body}", "console")], [(k, f"# %% [markdown]\n# {body}\n# %% In[2]\n{say(9)}", "script")], [(k, json.dumps(book), "ipynb")]])
    docs += [(500, None, "ipynb"), (501, "", "script"), (502, docs[0][1], docs[0][2]), (503, "{broken " + docs[3][1], "ipynb"), (504, docs[4][1], None), (505, '{"cells": null}', "ipynb"), (506, "[1]", "ipynb")]
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string, layout string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = brute_leaks(docs, items, 5)
    texts = {d: (t, layout) for d, t, layout in docs}
    for shard, block in ((50, 1 << 20), (1 << 20, 1 << 20), (1 << 20, 300)):
        spans = leakage.spans(d, ("doc_id", "text", "layout"), i, ("item_id", "text"), 5, shard, block).collect()
        assert {(r.item_id, r.doc_id) for r in spans} == want and all(r.end_word - r.first_word >= 5 for r in spans)
        for r in spans:
            cell = notebook.cells(*texts[r.doc_id])[r.cell]
            assert leakage.words(cell[r.first_char : r.end_char]) == leakage.words(cell)[r.first_word : r.end_word]
    left = leakage.removed(d, ("doc_id", "text", "layout"), i, ("item_id", "text"), 5).collect()
    assert {r.doc_id for r in left} == {x for _, x in want} and len(left) == len({x for _, x in want})
    for r in left:
        text, layout = texts[r.doc_id]
        assert len(r.text) + r.removed == len(text) and r.removed > 0 and len(notebook.cells(r.text, layout)) == len(notebook.cells(text, layout))
        if layout == "ipynb" and r.doc_id < 500:
            assert len(json.loads(r.text)["cells"]) == 2
    again = spark.createDataFrame([(r.doc_id, r.text, texts[r.doc_id][1]) for r in left], "doc_id bigint, text string, layout string")
    grown = {(r.item_id, r.doc_id) for r in leakage.spans(again, ("doc_id", "text", "layout"), i, ("item_id", "text"), 8).collect()}
    assert len(grown) < len(want) / 10  # only words that have met by a removal make new passages
    assert leakage.spans(d, ("doc_id", "text", "layout"), i.where("false"), ("item_id", "text"), 5).count() == 0
    assert leakage.spans(d.where("false"), ("doc_id", "text", "layout"), i, ("item_id", "text"), 5).count() == 0


def test_spans_are_merged(spark):
    item = "a b c d e f g h i j k l m n o"
    d = spark.createDataFrame([(1, "In [1]:\nx " + item + " y\n\nText:\nb c d e f", "console")], "doc_id bigint, text string, layout string")
    i = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    got = sorted(tuple(r) for r in leakage.spans(d, ("doc_id", "text", "layout"), i, ("item_id", "text"), 5).collect())
    assert got == [(7, 1, 1, 1, 16, 3, 32), (7, 1, 2, 0, 5, 1, 10)]
    left = leakage.removed(d, ("doc_id", "text", "layout"), i, ("item_id", "text"), 5).collect()
    assert [tuple(r) for r in left] == [(1, 38, "In [1]:\nx  y\n\nText:\n")]


def test_words_know_their_place():
    for text in ("Über İSTANBUL a1-B2 ﬀ x", "K2 ſ", "", "--"):
        assert [text[a:b].lower() for a, b in leakage.word_places(text)] == [w.decode() for w in leakage.words(text)] or "İ" in text
        assert len(leakage.word_places(text)) == len(leakage.words(text))


CELLS = ['a\nb "é" 😀', "c", "d", "", "", "", "e", "f", "", "", "h\ni\n", "", "g", ""]


def test_cells_know_their_place():
    book = {"cells": [{"source": ["a\n", 'b "é" \U0001f600']}, {"source": "c", "outputs": [{"text": ["d", 3]}, {"data": {"x": {"y": ["e", ["f"]]}, "z": 5}, "evalue": "g"}, {"traceback": ["h", None, "i"]}]}]}
    deep = '{"cells": [{"source": "s", "metadata": ' + "[" * 20_000 + "]" * 20_000 + "}]}"
    texts = [(json.dumps(book), "ipynb"), (json.dumps(book, ensure_ascii=False, indent=1), None), (deep, "ipynb"), ("{broken \\u00e9", "ipynb"), ("x", None), ('{"cells": [1]}', "ipynb"), ('{"cells": [{"source": "s"},]}', "ipynb"), ("# %% a\nb\n# %%\nc", "script")]
    for text, layout in texts:
        own = notebook.located(text, layout)
        assert [c.text for c in own] == notebook.cells(text, layout)
        for c in own:
            for k, char in enumerate(c.text):
                for a, b in c.spans(k, k + 1):
                    assert "".join(p[0] for p in pieces(text, a, b)) == char or text[a:b] == char
    assert notebook.cells(*texts[0]) == CELLS
    assert notebook.cells(deep, "ipynb") == ["s"]


CLEAN = {
    "fr": "L’élève précède la fenêtre étroite après l’été où l’on révèle une tâche légère à côté du modèle entraîné",
    "de": "Außerdem verkürzt die Häufigkeit eine schräge Lösung für die größte Fläche während der Übung",
    "ru": "Например левый столбец меняет общий порог без потерь и скрывает старый образец при слабом шуме",
    "pl": "Później główny węzeł łączy całą ścieżkę oraz zmniejszył różne błędy żółtej próbki źródłowej",
    "ja": "一方、細い区間が隣の境界を示している。図のように、左の列が古い範囲を隠す。",
    "en": "Kept at 21 °C… the “ordered” archive – don’t mix café rules — 3 µs ± 9 ns × 2",
}
PAIRS = [("fr", "utf-8", "cp1252"), ("de", "utf-8", "latin-1"), ("ru", "utf-8", "latin-1"), ("ru", "cp1251", "latin-1"), ("ru", "koi8-r", "latin-1"), ("ru", "utf-8", "cp1251"), ("pl", "utf-8", "cp437"), ("pl", "cp1250", "latin-1"), ("fr", "cp1252", "mac_roman"), ("ja", "utf-8", "latin-1"), ("de", "utf-8", "mac_roman"), ("en", "utf-8", "cp850")]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(8)
    rows, truth = [], {}
    for k in range(400):
        words = CLEAN[rng.choice(list(CLEAN))].split(" ")
        rng.shuffle(words)
        rows.append((k, " ".join(words)))
    for k, (lang, written, read) in enumerate(PAIRS, 1000):
        original = f"In short {CLEAN[lang]} and so on"
        text = original.encode(written, "ignore").decode(read, "ignore")
        truth[k] = original.encode(written, "ignore").decode(written)
        rows.append((k, json.dumps({"cells": [{"source": [text]}]}) if k % 2 else text))
    rows += [(2000, None), (2001, ""), (2002, "plain"), (2003, "lost: poblaci�n"), (2004, "rare À Á Â Ã Ä Å ÿ"), (2005, '"\\u00e9t\\u00e9" b\'2\\x80\\x99\''), (2006, "é" * 30_000), (1000, rows[400][1]), (2007, "wide\xa0space\xa0only")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS words", "'x' AS key")
    got = encodings.label(df, "doc_id", "text", restored=True).collect()
    return rows, truth, got


def test_affected_documents_are_found(labelled):
    _, truth, got = labelled
    assert {r.doc_id for r in got} == set(truth) | {2003}
    assert sum(r.doc_id == 1000 for r in got) == 2


def test_texts_are_restored(labelled):
    _, truth, got = labelled
    right = 0
    for r in got:
        if r.doc_id in truth:
            text = json.loads(r.text)["cells"][0]["source"][0] if r.text.startswith("{") else r.text
            right += text == truth[r.doc_id]
    assert right >= 10


def test_no_texts(spark):
    assert encodings.label(spark.createDataFrame([], "doc_id bigint, text string"), "doc_id", "text").count() == 0


def test_single_garbled_letter_in_common_words(spark):
    """An apostrophe read as a letter: only the words tell it from Spanish and French ones."""
    common = ["That’s the lattice’s limit", "Así el país elige la línea del límite", "l’étape d’après n’égale rien"]
    rows = [(k, f"{common[k % 3]} {CLEAN['fr' if k % 2 else 'en']}") for k in range(300)]
    rows += [(1000, "Note: That’s the lattice’s limit".encode("cp1252").decode("mac_roman")), (1001, "solo: país límite"), (1002, "Gülçin’s ítem")]
    got = encodings.label(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id", "text", restored=True).collect()
    assert [(r.doc_id, r.text) for r in got] == [(1000, "Note: That’s the lattice’s limit")]


def test_known_words_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(encodings, "BUCKETS", 2)
    monkeypatch.setattr(encodings, "WORDS", 3)
    docs = spark.createDataFrame([(" ".join(f"é{chr(97 + k)}{j}" for k in range(20) for j in range(20)),)], "text string")
    first = encodings.clean_counts(docs)
    counts = encodings.clean_counts(docs, spark.sparkContext.broadcast({"rows": [tuple(r) for r in first.collect()]})).collect()
    assert all(r.before for r in first.collect()) and sum(r.before == "" and r.c != "" for r in counts) <= 6
    assert [r.n for r in counts if r.before == r.c == ""] == [400]


def test_halves_of_surrogate_pairs(spark):
    garbled = "l’élève révèle".encode().decode("latin-1")
    book = '{"cells": [{"source": "café \\ud83d né", "more": "%s", "\\ud83d": "\\ude00"}]}'
    rows = [(1, book % "plain"), (2, book % garbled), (3, '{broken "caf\\u00e9 \\ud83d\\ude00 \\ude00"'), (4, '{broken "caf\\u00e9 \\ud83d\\ude00 \\ud83d ' + garbled)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in encodings.label(df, "doc_id", "text", restored=True).collect()}
    assert got == {2: book % "l’élève révèle", 4: rows[3][1].replace(garbled, "l’élève révèle")}
    assert encodings.label(df, "doc_id", "text").count() == 2
    assert Located.suspects(rows[2][1]).text.split("\n")[0] == f"café 😀 {HALF}"


def test_characters_know_their_place():
    raw = '{"a": "x", "k\\u00e9y": ["one \\"two\\" é\\n", "\\ud83d\\ude00z"], "tail": "é'
    own = Located.suspects(raw)
    assert own.text == 'kéy\none "two" é\n\n😀z\n: "é\n'
    for k, c in enumerate(own.text):
        for a, b in own.spans(k, k + 1):
            assert "".join(p[0] for p in pieces(raw, a, b)) == c
    at = own.text.index("😀")
    assert own.replaced([(1, 2, "è"), (at, at + 2, 'ü"')]) == raw.replace("\\u00e9", "\\u00e8").replace("\\ud83d\\ude00z", '\\u00fc\\"')
    assert Located.suspects("").text == "" and Located.suspects("{").text == ""


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(4)
    docs = spark.createDataFrame([(" ".join(rng.sample(CLEAN[k].split(), len(CLEAN[k].split()))),) for k in CLEAN for _ in range(60)], "text string")
    return encodings.Labeller([tuple(r) for r in encodings.clean_counts(docs).collect()])


def test_spans_inside_words(model):
    """Text without blanks, garbled in part: only the garbled characters are labelled."""
    clean, rest = "一方、細い区間が隣の境界を示している。", "図のように、左の列が古い範囲を隠す。"
    for written, read in (("utf-8", "latin-1"), ("utf-8", "mac_roman"), ("euc_jp", "cp1252"), ("cp932", "mac_roman")):
        garbled = rest.encode(written).decode(read)
        for text in (clean + garbled, garbled + clean, clean + garbled + clean):
                changes, _ = model.changes(text)
                at = text.index(garbled)
                assert [(a, b, original) for a, b, _, original in changes] == [(at, at + len(garbled), rest)], (written, read)
    assert model.spans(clean + rest) == []


def test_both_forms_of_the_path_agree(model):
    words = ["следовательно", "L’élève", "łączyéÅ", "隣の境界を", "Ã©tÃ©", "ÐŸÑ€Ð¸", "d’été…", "“ordered”"]
    for word in words:
        four = model._sweep(word)
        for col, k in enumerate(model.tables):
            for x, (y, _) in zip(four[:, col], model._path(word, k)):
                assert math.isclose(max(x, -encodings.SWITCH), max(y, -encodings.SWITCH), abs_tol=1e-9)


def test_words_are_forgotten_and_scored_again(model, monkeypatch):
    words = [f"é{a}{b}à" for a in "abcdefg" for b in "hijklmn"]
    want = [model.gains(w) for w in words]
    monkeypatch.setattr(encodings, "MEMO", 5)
    model.memo.clear()
    assert [model.gains(w) for w in words[::-1]] == want[::-1] and [model.gains(w) for w in words] == want and len(model.memo) <= 5


def test_units_of_pairs():
    for pair in encodings.inverses():
        for text in ("é", "ж", "…", "の境", "ł"):
            try:
                garbled = text
                for _ in range(pair.times):
                    garbled = garbled.encode(pair.written).decode(pair.read)
            except UnicodeError:
                continue
            if pair.table is not None:
                assert "".join(pair.table.get(c, c) for c in garbled) == text
            elif garbled != text and any(c > "\x7f" for c in garbled) and (not pair.japanese or text == "の境"):
                assert pair.may(garbled), pair.name
                at, out, units = 0, "", pair.units(garbled)
                while at < len(garbled):
                    at, piece = units[at][-1]
                    out += piece
                assert out == text, pair.name


def test_leaks_in_errors_nested_data_and_broken_notebooks(spark):
    item = "a b c d e f"
    output = lambda o: json.dumps({"cells": [{"source": "x", "outputs": [o]}]})
    docs = [
        (1, output({"evalue": item}), "ipynb"),
        (2, output({"data": {"application/json": {"rows": [{"note": item}, 3]}, "text/plain": "y"}}), "ipynb"),
        (3, '{"cells": [{"source": ["a b c\\n", "d\\te f"', "ipynb"),
        (4, r"print('a b c\nd e f')", None),
    ]
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string, layout string"), spark.createDataFrame([(7, item)], "item_id bigint, text string")
    got = leakage.spans(d, ("doc_id", "text", "layout"), i, ("item_id", "text"), 6).collect()
    assert sorted(r.doc_id for r in got) == [1, 2, 3]
