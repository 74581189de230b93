"""Pure-Python parts of the text operators, and their properties."""

import random

import numpy as np
import pytest

from garimpo.llm import encoding, language, mixing, ocr_noise, packing, residue, truncation
from garimpo.llm.common import WordHashes, shingle_sets
from garimpo.llm.history import beam_search, build_links, tuned_beam


def test_shingles_are_runs_of_words():
    a, b, c = shingle_sets(["A b, c d!", "a B c\nD", "x y"], 3, WordHashes())
    assert len(a) == 2 and (a == b).all() and len(c) == 0
    assert [len(s) for s in shingle_sets(["", "a"], 3, WordHashes())] == [0, 0]


@pytest.mark.parametrize("codec", ["cp1252", "cp850", "cp437", "mac_roman"])
def test_misreadings_explain_wrong_codecs(codec):
    for c in "çãéºü":
        wrong = encoding._read(c.encode("utf-8"), codec)
        assert wrong in encoding.misreadings(c)
        assert encoding._read(wrong.encode("utf-8"), codec) in encoding.misreadings(c)


def test_alignment_pairs_runs():
    assert encoding.align("contrataÃ§Ã£o", "contratação") == [("Ã§", "ç"), ("Ã£", "ã")]
    assert encoding.align("sess?o", "sessão") == [("?", "ã")]


def test_segments_and_backoff():
    assert language.segments("\n\na\n \nb\nc\n\n\n d") == ["a", "b\nc", "d"]
    model = language.Model({"casa": [9, 1, 0, 0, 0]}, {"a": [5, 5, 1, 1, 1], " xyz": [0, 0, 9, 0, 0], "zz": [0, 0, 0, 0, 9]})
    assert int(np.argmax(model.word("casa"))) == 0
    assert int(np.argmax(model.word("xyzq"))) == 2
    assert int(np.argmax(model.word("qzzq"))) == 4
    assert not model.word("qqqq").any()


def test_lengths_by_store():
    import html
    import json

    text = 'a "é" & <b>\n€\t\\ 😀'
    got = dict(zip(truncation.MEASURES, truncation.lengths(text)))
    assert got["utf8"] == len(text.encode()) and got["utf16"] * 2 == len(text.encode("utf-16-le"))
    assert got["crlf"] == len(text.replace("\n", "\r\n")) and got["html"] == len(html.escape(text).replace("&#x27;", "&#039;"))
    assert got["json_ascii"] == len(json.dumps(text)) and got["json"] == len(json.dumps(text, ensure_ascii=False))


ENDINGS = [
    ("Fim da frase.", "stop"), ("Fim (ver anexo.)", "stop"), ("o prazo ser", "cut"), ("o prazo de", "cut"), ("o pra…", "omitted"), ("o pra [...]", "omitted"), ("fotos etc...", "stop"),
    ("x.\n\n| a | b |", "row"), ("x.\n\n| a | b", "cut"), ("x.\n\nhttps://a.example/b", "link"), ("x.\n\nPágina 3 de 4", "foot"), ("x.\n\n<!-- Página 2 -->", "foot"),
    ("O texto acaba.\n\nVila Nova, 3 de maio de 2026\nComissão Permanente de Contratação", "signature"), ("", "empty"), ("  \n", "empty"), ("A Prefeitura - Aviso 3\ntexto que segue\nA PREFEITURA - AVISO 3", "running"),
]


@pytest.mark.parametrize("text,kind", ENDINGS)
def test_endings(text, kind):
    assert truncation.ending(text)[0] == kind


def test_automaton_finds_all_within_distance():
    rng = random.Random(3)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(2, 6))): 1 for _ in range(150)}
    root = ocr_noise.trie(words)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, prev = [i] + [0] * len(b), row
            for j, y in enumerate(b, 1):
                row[j] = min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y))
        return row[-1]

    for _ in range(40):
        q = "".join(rng.choice("abc") for _ in range(rng.randint(1, 6)))
        for k in (0, 1, 2):
            assert dict(ocr_noise.within(root, q, k)) == {w: distance(q, w) for w in words if distance(q, w) <= k}


def test_corrections_and_furniture():
    words = {"contratação": 900, "merenda": 500, "desclassificadas": 100}
    root = ocr_noise.trie(words)
    best = lambda w: [c[0] for c in ocr_noise.corrections(root, words, w)]
    assert best("c0ntratação") == ["contratação"] and best("mcrenda") == ["merenda"] and best("desdassificadas") == ["desclassificadas"]
    assert best("merendas") == []
    page = "Prefeitura de Vila Nova - Aviso 1/2026  Pág. {}\ntexto da página {} que se-\ngue adiante\n\n"
    text = "".join(page.format(i, i) for i in range(1, 5))
    f = ocr_noise.Furniture(text.split("\n"))
    assert len(f.running) == 4 and len(f.numbers) == 4
    fixed = ocr_noise.repair_text(text, {}, {"segue"})
    assert "Prefeitura" not in fixed and "que segue adiante" in fixed
    assert ocr_noise.repair_text("", {}, {}) == ""


def test_best_fit_against_a_scan():
    rng = np.random.default_rng(5)
    sizes = rng.integers(0, 101, 400)
    where, room = packing.best_fit_decreasing(sizes, 100)
    left: list[int] = []
    for s in sorted(sizes.tolist(), reverse=True):
        fits = [b for b in range(len(left)) if left[b] >= s]
        b = min(fits, key=lambda x: left[x]) if fits else len(left)
        if not fits:
            left.append(100)
        left[b] -= s
    assert sorted(left) == sorted(room.tolist())
    assert all(sizes[where == b].sum() + room[b] == 100 for b in range(len(room)))
    assert packing.best_fit_decreasing(np.array([], int), 10)[1].tolist() == []


def test_apportionment():
    assert mixing.apportion([0.5, 0.3, 0.2], [1, 1, 1], [99, 99, 99], 10) == [5, 3, 2]
    assert mixing.apportion([0.5, 0.5], [1, 1], [2, 99], 10) == [2, 8]
    assert mixing.apportion([], [], [], 10) == [] and mixing.apportion([1.0], [2.0], [3], 0) == [0]


def test_apportionment_of_many_blocks_equals_one_by_one():
    rng = random.Random(15)
    for _ in range(200):
        k = rng.randint(1, 8)
        shares, block, limit = [rng.random() for _ in range(k)], [rng.uniform(0.5, 4) for _ in range(k)], [rng.randint(0, 300) for _ in range(k)]
        total, quota, given = rng.uniform(0, 900), [0] * k, 0.0
        while best := [(shares[i] / ((quota[i] + 0.5) * block[i]), i) for i in range(k) if quota[i] < limit[i]]:
            i = max(best)[1]
            if given + block[i] / 2 > total:
                break
            quota[i] += 1
            given += block[i]
        assert mixing.apportion(shares, block, limit, total) == quota


def test_walks_end_at_the_nearest_point():
    rng = np.random.default_rng(1)
    points = np.sort(rng.integers(0, 2**63, 500, dtype=np.uint64))
    links = build_links(len(points), rng)
    asked = np.concatenate([points[::7], rng.integers(0, 2**63, 100, dtype=np.uint64)])
    near = points[beam_search(points, links, asked, tuned_beam(points, links, rng))[:, 0]]
    for q, p in zip(asked, near):
        assert min(abs(int(q) - int(x)) for x in points) == abs(int(q) - int(p))
    one = np.array([5], np.uint64)
    assert beam_search(one, build_links(1, rng), np.array([9], np.uint64), 4).tolist() == [[0]]


FILLER = [("teste teste teste teste teste", True), ("asdf lkjh gfds hjkl asdas", True), ("lorem ipsum dolor lorem ipsum amet", True), ("O prazo de entrega será de trinta dias úteis.", False), ("", False)]


@pytest.mark.parametrize("text,want", FILLER)
def test_filler(text, want):
    assert residue.is_filler(text, frozenset(("lorem", "ipsum", "dolor", "amet"))) is want


PAGES = [
    ("Página não encontrada.", True), ("<noscript>Enable JavaScript</noscript>", True), ('Traceback (most recent call last):\n  File "a.py", line 3, in f\nKeyError: 1', True), ('{"status":404,"message":"x"}', True),
    ("O sistema em JavaScript deverá exibir a mensagem de página não encontrada em até 5 segundos, conforme o termo de referência, e registrar a ocorrência no histórico do contrato.", False), ("A vigência do contrato será de 12 meses.", False), ("", False),
]


@pytest.mark.parametrize("text,want", PAGES)
def test_error_pages(text, want):
    assert residue.error_page(text) is want
