"""The text operators on small tables: brute force, nulls, empty and long texts, repeated rows, clashing names."""

import random

import pytest
from pyspark.sql import functions as F

from garimpo.llm import encoding, history, language, mixing, near_dup, ocr_noise, packing, residue, truncation
from garimpo.llm.common import WORD

WORDS = "prazo entrega contrato edital serviço obra compra recurso proposta empresa valor termo anexo sessão data local".split()


def sentence(rng, n=12):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))


def brute(rows, n, threshold):
    def runs(t):
        w = WORD.findall(t.lower())
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    sets = [(i, runs(t)) for i, t in rows if i is not None and t is not None]
    return {(min(a, b), max(a, b)) for k, (a, x) in enumerate(sets) for b, y in sets[k + 1 :] if a != b and x and y and len(x & y) >= threshold * len(x | y)}


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(4)
    rows, i = [], 0
    for _ in range(40):
        base = [sentence(rng) for _ in range(12)]
        for _ in range(rng.randint(1, 3)):
            copy = [s if rng.random() < 0.9 else sentence(rng) for s in base]
            rows.append((i, ". ".join(copy)))
            i += 1
    rows += [(i + k, "igual " * 3 + sentence(random.Random(9), 40)) for k in range(5)] + [(i + 6, None), (None, "x"), (i + 7, ""), (i + 8, "a b"), rows[0], (i + 9, "longo " + sentence(rng, 30_000))]
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "`my id` long, text string, value int, df int")
    pairs, members = near_dup.near_duplicate_pairs(df, id_col="my id", text_col="text", words=3, threshold=0.6, list_limit=4)
    got = {(r.id_a, r.id_b) for r in near_dup.expand_pairs(pairs, members).collect()}
    # candidates come from samples: pairs clearly above the threshold are all found, those at it nearly all, and no other
    want = brute(rows, 3, 0.6)
    assert got <= want and brute(rows, 3, 0.75) <= got and len(got) >= 0.95 * len(want)


def pairs_found(spark, texts, **more):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    pairs, members = near_dup.near_duplicate_pairs(df, id_col="id", text_col="text", words=3, threshold=0.6, **more)
    return {(r.id_a, r.id_b) for r in near_dup.expand_pairs(pairs, members).collect()}


def test_near_duplicates_in_chains_and_families(spark):
    rng = random.Random(21)
    new = lambda: f"w{rng.randrange(10**9)}"
    texts = []
    for _ in range(12):  # re-issues, each made from the one before
        text = [new() for _ in range(150)]
        for _ in range(20):
            text = [w if rng.random() < 0.98 else new() for w in text]
            texts.append(" ".join(text))
    hot = [new() for _ in range(120)]
    for _ in range(12):  # a family with sub-variants, each with a passage that its texts alone have
        passage = [new() for _ in range(25)]
        texts += [" ".join(hot + passage + [new() for _ in range(4)]) for _ in range(8)]
    want = brute(list(enumerate(texts)), 3, 0.6)
    assert len(want) > 5000 and pairs_found(spark, texts, list_limit=8) == want


def test_near_duplicates_of_short_texts(spark):
    rng = random.Random(22)
    texts = []
    for _ in range(40):
        text = [f"w{rng.randrange(10**9)}" for _ in range(7)]
        texts += [" ".join(text[:n]) for n in range(3, 8)]
    texts += [f"aviso de pregão eletrônico número{i}" for i in range(30)] + ["aviso de pregão eletrônico", "aviso de pregão"]
    assert pairs_found(spark, texts, list_limit=4) == brute(list(enumerate(texts)), 3, 0.6) != set()


def test_near_duplicates_a_little_longer_than_a_sketch(spark):
    rng = random.Random(23)
    texts = []
    for _ in range(500):  # one text holds the other
        n = rng.randint(60, 89)
        text = [f"w{rng.randrange(10**9)}" for _ in range(n + 2)]
        texts += [" ".join(text), " ".join(text[: int(n * rng.uniform(0.62, 0.75)) + 2])]
    assert pairs_found(spark, texts) == brute(list(enumerate(texts)), 3, 0.6)


def test_groups_and_empty_tables(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (3, 3)] + [(20 + k, 21 + k) for k in range(12)], "a long, b long")
    got = {r.id: r.group for r in near_dup.connected_groups(edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8} | {20 + k: 20 for k in range(13)}
    none = spark.createDataFrame([], "id long, text string")
    assert near_dup.near_duplicate_groups(none, id_col="id", text_col="text").count() == 0


def test_garbled_words_are_found_and_restored(spark):
    clean = ["A sessão pública será realizada após análise da contratação", "O prazo não será prorrogável até a decisão da comissão técnica", "A vigência é de três dias úteis após a publicação"]
    rows = [(i, clean[i % 3] + f" item {i}.") for i in range(60)]
    bad = [(100 + i, "\n".join(clean).encode().decode("cp1252", "replace") + ".") for i in range(2)]
    bad += [(110, "\n".join(clean).encode("cp850").decode("cp437", "replace")), (111, "\n".join(clean).replace("ã", "�"))]
    rows += bad + [(200, None), (201, ""), (202, "«Ţurdeş» e «Łobzek»"), (None, clean[0])]
    df = spark.createDataFrame([(a, b, "k") for a, b in rows], "id long, text string, key string")
    found = {r.id: r.garbled_words for r in encoding.garbled_records(df, id_col="id", text_col="text").collect()}
    assert {100, 101, 111} <= set(found) and not set(found) - {100, 101, 110, 111}
    fixed = {r.id: r.restored for r in encoding.restored_records(df, id_col="id", text_col="text").collect()}
    assert fixed[100] == "\n".join(clean) + "."


def test_garbled_words_where_a_third_of_the_rows_is_garbled_alike(spark):
    wrong = lambda t: t.encode().decode("cp1252", "replace")
    clean, hot = "A sessão pública da contratação será após análise", "A sessão pública da contratação será após fundação e doação de órgãos"
    rows = [(i, f"{clean} item {i}.") for i in range(40)] + [(100 + i, f"{wrong(hot)} item {i}.") for i in range(30)]
    rows += [(200, wrong("adjudicação homologação licitação"))]
    copy = "A decisão da comissão técnica é sobre a gestão e união"
    rows += [(300 + i, f"{copy} item {i}.") for i in range(20)] + [(400 + i, copy.encode("cp850").decode("cp437", "replace")) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, text string")
    found = {r.id: r.garbled_words for r in encoding.garbled_records(df, id_col="id", text_col="text").collect()}
    assert set(found) == {i for i, _ in rows if 100 <= i <= 200 or i >= 400} and found[100] == 8
    fixed = {r.id: r.restored for r in encoding.restored_records(df, id_col="id", text_col="text").collect()}
    assert fixed[100] == f"{hot} item 0." and fixed[200] == "adjudicação homologação licitação" and fixed[400] == copy


TEXTS = {
    "pt": "o prazo de vigência do contrato será de doze meses contados da publicação deste aviso e poderá ser prorrogado",
    "es": "el plazo de vigencia del contrato será de doce meses contados desde la publicación de este aviso y podrá ampliarse",
    "en": "the term of the contract shall be twelve months from the date of this notice and may be extended by the agency",
    "fr": "la durée du marché est fixée à douze mois à compter de la publication du présent avis et pourra être prolongée",
    "de": "die Laufzeit des Vertrages beträgt zwölf Monate ab der Veröffentlichung dieser Bekanntmachung und kann verlängert werden",
}


def test_language_of_records_and_segments(spark):
    train = spark.createDataFrame([(i, (TEXTS[x] + ". ") * 3, x) for i, x in enumerate(list(TEXTS) * 3)], "id long, text string, lang string")
    model = language.fit(train, id_col="id", text_col="text", lang_col="lang")
    rows = [(1, TEXTS["pt"], "pt-BR"), (2, TEXTS["es"], "por"), (3, TEXTS["pt"] + "\n\n" + TEXTS["de"], "pt"), (4, TEXTS["en"], None), (5, TEXTS["fr"], "francês"), (6, None, "pt"), (7, "", "pt"), (8, "curto", None), (9, TEXTS["de"], "??")]
    df = spark.createDataFrame(rows, "id long, text string, label string")
    judged = language.segment_languages(df, model, id_col="id", text_col="text", label_col="label")
    got = sorted((r.id, r.segment_no, r.lang) for r in language.mislabelled(judged).collect())
    assert got == [(2, 1, "es"), (3, 1, "pt"), (3, 2, "de"), (4, 1, "en"), (9, 1, "de")]
    labels = spark.createDataFrame([("es-419",), ("Português",), ("deu",), ("und",), ("",), ("de_DE",), ("alemão",)], "x string")
    assert [r.y for r in labels.select(language.label_language(F.col("x")).alias("y")).collect()] == ["es", "pt", "de", None, None, "de", "de"]


def test_truncation_limits_and_sources(spark):
    rng = random.Random(6)
    rows = []
    for i in range(120):
        text = ". ".join(sentence(rng, 10) for _ in range(12)) + "."
        rows.append((i, i, text[:400] if i < 20 else text[: 500 + i] + "." if i < 110 else text))
    rows += [(200, 500, None), (201, None, "cortado no me"), (202, 1, "")]
    df = spark.createDataFrame([(a, b, c, "z") for a, b, c in rows], "id long, candidate_id long, text string, kind string")
    cands = spark.createDataFrame([(i, ("  A " if i % 2 else "a") if i < 60 else None) for i in range(120)], "candidate_id long, source string").select("candidate_id", F.struct("source").alias("metadata"))
    records, limits = truncation.truncated(df, cands, id_col="id", text_col="text")
    cut = {r.id for r in records.where("truncated").collect()}
    assert {i for i in range(20) if not rows[i][2].rstrip().endswith(".")} | {201} == cut
    assert ("a", "chars", 400) in {(r.source, r.measure, r.length) for r in limits.collect()}
    by = {r.source: r.texts for r in truncation.truncation_by_source(records).collect()}
    assert by == {"a": 61, "unknown": 61}


def test_noise_kinds_and_repair(spark):
    rng = random.Random(8)
    lines = ["contratação de serviços para merenda escolar", "a entrega será parcelada mediante ordem de fornecimento", "os interessados deverão apresentar documentação", "cronograma físico-financeiro em anexo"]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(8)) + ".") for i in range(60)]
    scan = "\n".join(f"Prefeitura de Vila Nova - Aviso 1/2026  {p}\ncontrataçã0 de serv1ços para {'mcrenda' if p < 3 else 'merenda'} esco-\nlar a entrega s3rá parcelada\n" for p in range(1, 5))
    rows += [(100, scan), (101, None), (102, ""), (103, "físico-\nfinanceiro H2O-8B44 e LT-64D/2025.")]
    df = spark.createDataFrame(rows, "id long, text string")
    kinds = {(r.id, r.noise_kind) for r in ocr_noise.noise_kinds(df, id_col="id", text_col="text").collect()}
    assert kinds == {(100, k) for k in ("header", "pageno", "hyphen", "misread")}
    fixed = {r.id: r.repaired for r in ocr_noise.repaired(df, id_col="id", text_col="text").collect()}
    assert "contratação de serviços para merenda escolar" in fixed[100] and "Prefeitura" not in fixed[100]


def test_history_equals_one_by_one(spark):
    rng = random.Random(10)
    rows, urls_ = [], []
    for i in range(1, 301):
        rows.append((i, i, 0 if i < 150 else 1 + (i - 150) // 40, rng.choice([None, f"{rng.randint(1, 60):064x}", f"SHA256:{rng.randint(1, 200):064X}"]), rng.choice([0, 5, None])))
        urls_.append((i, rng.choice([f"https://a.example/f{rng.randint(1, 150)}.pdf", f"http://WWW.a.example:80//f{rng.randint(1, 150)}.pdf?utm_source=x#p", None])))

    def key(u):
        return None if u is None else u.split("/f")[1].split(".pdf")[0]

    held_h, held_u, want = {}, {}, set()
    for (i, _, b, h, n), (_, u) in zip(rows, urls_):
        h = None if h is None or n == 0 else h.lower().replace("sha256:", "")
        hits = [d[k] for d, k in ((held_h, h), (held_u, key(u))) if k is not None and k in d]
        if b and hits:
            want.add((min(hits), i))
            continue
        for d, k in ((held_h, h), (held_u, key(u))):
            if k is not None:
                d.setdefault(k, i)
    d = spark.createDataFrame(rows, "download_id long, candidate_id long, batch_no int, content_hash string, content_length long")
    c = spark.createDataFrame(urls_, "candidate_id long, url string")
    got = {(r.accepted_id, r.duplicate_id) for r in history.duplicates_of_history(d, c, part_nodes=40).collect()}
    assert got == want
    assert history.duplicates_of_history(d.limit(0), c).count() == 0


SAME = ["https://a.example/x/y.pdf?b=2&a=1", " http://www.A.example:443/x/./z/../y%2Epdf/?a=1&utm_medium=m&b=2#top", "https://a.example./x//y.pdf;jsessionid=9?sid=1&b=2&a=1"]


def test_file_urls(spark):
    rows = [(u,) for u in [*SAME, "https://a.example/X/y.pdf?b=2&a=1", "https://b.example/x/y.pdf?b=2&a=1", None, "", "https://a.example/%E7%2f"]]
    got = [r.k for r in spark.createDataFrame(rows, "u string").select(history.file_url(F.col("u")).alias("k")).collect()]
    assert len(set(got[:3])) == 1 and len(set(got[:5])) == 3 and got[5] is None


def test_compaction_keeps_all_keys(spark):
    index = history.HistoryIndex(3, fanout=2)
    for s in range(4):
        keys = spark.range(s * 50, s * 50 + 60).select("id", F.lit(s).alias("segment"), F.xxhash64("id").alias("point"), F.xxhash64(F.lit(1), "id").alias("check"))
        index.add(keys)
    assert sum(len(level) for level in index.levels) < 4
    asked = spark.range(0, 300).select(F.xxhash64("id").alias("point"), F.xxhash64(F.lit(1), "id").alias("check"), F.lit(9).alias("segment"))
    found = index.search(asked).select("accepted_id").distinct()
    assert sorted(r.accepted_id for r in found.collect()) == list(range(210))


def test_packing_keeps_every_token(spark):
    rng = random.Random(12)
    sizes = [(i, rng.choice([0, rng.randint(1, 60), rng.randint(1, 400)])) for i in range(500)] + [(7, 3)]
    df = spark.createDataFrame(sizes, "id long, tokens long")
    kinds = spark.createDataFrame([("s", 100), ("l", 1000), ("s", 100), (None, 5), ("x", 0)], "container_name string, capacity_tokens int")
    packed = packing.pack(df, kinds, shard_items=60)
    for name, capacity in (("s", 100), ("l", 1000)):
        mine = packed.where(F.col("container_name") == name)
        assert mine.agg(F.sum("piece_tokens")).first()[0] == sum(t for _, t in sizes)
        assert mine.groupBy("container_id").agg(F.sum("piece_tokens").alias("t")).agg(F.max("t")).first()[0] <= capacity
        assert mine.select("id").distinct().count() == 500
    report = {r.container_name: r for r in packing.packing_report(packed).collect()}
    assert report["l"].containers <= report["l"].least_containers + 2 and set(report) == {"s", "l"}
    assert packing.pack(df.limit(0), kinds).count() == 0


def test_mixing_meets_shares_within_repeats(spark):
    rng = random.Random(13)
    sizes = [(i, rng.choice(["a", "a", "a", "b", "c", None, "z"]), rng.randint(0, 400)) for i in range(3000)]
    df = spark.createDataFrame(sizes, "id long, source string, tokens long")
    weights = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.1, 2), ("missing", 0.1, 5)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix(df, weights, block_tokens=1000, shard_tokens=100_000)
    shares = {r.source: r for r in mixing.share_report(mixed, weights).collect()}
    for s, want in (("a", 0.5 / 0.9), ("b", 0.3 / 0.9), ("c", 0.1 / 0.9)):
        assert shares[s].actual_share == pytest.approx(want, abs=0.03)
        assert shares[s].most_copies <= shares[s].max_repeats
    assert shares["missing"].documents == 0
    again = mixing.mix(df, weights, block_tokens=1000, shard_tokens=100_000)
    assert sorted(mixed.collect()) == sorted(again.collect())
    assert mixing.mix(df.limit(0), weights).count() == 0


def test_mixing_of_a_scarce_source_over_many_shards(spark):
    rng = random.Random(14)
    sizes = [(i, "a", rng.randint(100, 300)) for i in range(3000)] + [(5000 + i, "b", 200) for i in range(10)]
    df = spark.createDataFrame(sizes, "id long, source string, tokens long")
    weights = spark.createDataFrame([("a", 0.98, 1), ("b", 0.02, 3)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix(df, weights, shard_tokens=20_000)
    shares = {r.source: r for r in mixing.share_report(mixed, weights).collect()}
    assert shares["b"].tokens == 10 * 200 * 3 and shares["a"].most_copies == 1
    assert shares["b"].actual_share == pytest.approx(0.02, abs=0.0005)


def test_residue_by_alignment(spark):
    rows = [(i, f"A vigência do contrato será de {i} meses, contados da publicação.\n\nO prazo de entrega é de {i} dias.") for i in range(40)]
    rows += [(100, "A {{ orgao }} do contrato será de 3 meses, contados da publicação."), (101, "A vigência do contrato será de [PRAZO] meses, contados da publicação."), (102, "teste teste teste teste teste teste"), (103, "Página não encontrada."), (104, None), (105, ""), (106, "A empresa ______, inscrita sob o nº ____, declara."), (107, "conjunto {a, b, c} do lote [1]")]
    df = spark.createDataFrame([(a, b, "x") for a, b in rows], "id long, text string, reason string")
    got = {(r.id, r.reason) for r in residue.flagged(df, id_col="id", text_col="text").collect()}
    assert got == {(100, "field"), (101, "field"), (102, "filler"), (103, "error_page")}
    kept = residue.without_residue(df, id_col="id", text_col="text")
    assert kept.count() == len(rows) - 4 and kept.columns == df.columns


def test_residue_of_copies_and_of_lines_without_context(spark):
    rows = [(i, "Fica designada {{ servidor }} como gestora substituta deste ajuste.") for i in range(9)]
    rows += [(20 + i, f"Texto comum {i} do aviso.\nObjeto: {{{{objeto}}}}") for i in range(9)] + [(40 + i, "{{ementa}}\nOutro texto simples.") for i in range(9)]
    rows += [(60 + i, f"Nota {'abcdefghi'[i] * 4} segue a frase fixa [[modelo]] do manual oficial.") for i in range(9)] + [(80, "Assinatura: ______")]
    df = spark.createDataFrame(rows, "id long, text string")
    got = {r.id for r in residue.flagged(df, id_col="id", text_col="text").where("reason = 'field'").collect()}
    assert got == {i for i, _ in rows if i < 60}


def test_a_stored_index_reads_only_new_batches(spark, tmp_path):
    rows = [(i, i, i // 100, f"{i % 170:064x}", 5) for i in range(400)]
    d = spark.createDataFrame(rows, "download_id long, candidate_id long, batch_no int, content_hash string, content_length long")
    c = spark.createDataFrame([], "candidate_id long, url string")
    path = f"file://{tmp_path}/index"
    whole = {(r.accepted_id, r.duplicate_id) for r in history.duplicates_of_history(d, c, part_nodes=16).collect()}
    early = history.duplicates_of_history(d.where("batch_no < 3"), c, path=path, part_nodes=16)
    first = {(r.accepted_id, r.duplicate_id) for r in early.collect()}
    # the history's rows are gone: only the stored graphs know them
    late = {(r.accepted_id, r.duplicate_id) for r in history.duplicates_of_history(d.where("batch_no = 3"), c, path=path, part_nodes=16).collect()}
    assert first | late == whole and late == {(i % 170, i) for i in range(300, 400)}
    index = history.HistoryIndex(path=path, spark=spark)
    assert index.last == 3 and sum(s["keys"] for s in index.shards) == 170
    assert history.duplicates_of_history(d, c, path=path).count() == 0


def test_long_chains_within_a_batch(spark):
    # each row repeats the one before by one key and the next by the other
    rows = [(i, i, 1, f"{(i + 1) // 2:064x}", 5) for i in range(1, 60)]
    d = spark.createDataFrame(rows, "download_id long, candidate_id long, batch_no int, content_hash string, content_length long")
    c = spark.createDataFrame([(i, f"https://a.example/{i // 2}") for i in range(1, 60)], "candidate_id long, url string")
    got = {(r.accepted_id, r.duplicate_id) for r in history.duplicates_of_history(d, c).collect()}
    assert got == {(i - 1, i) for i in range(2, 60, 2)}


def test_half_full_containers_stay_in_bounded_shards(spark):
    sizes = spark.createDataFrame([(i, 60) for i in range(600)], "id long, tokens long")
    kinds = spark.createDataFrame([("s", 100)], "container_name string, capacity_tokens int")
    shards = []
    real = packing._pack_shards
    packing._pack_shards = lambda items: (shards.append(items.groupBy("container_name", "shard").count().agg(F.max("count")).first()[0]), real(items))[1]
    try:
        packed = packing.pack(sizes, kinds, shard_items=100)
        assert packed.select("container_id").distinct().count() == 600
    finally:
        packing._pack_shards = real
    assert max(shards) <= 150 and len(shards) <= 3


@pytest.mark.parametrize("few", [0, 10, 100_000])
def test_repeats_within_a_batch_by_rounds_and_chains(spark, monkeypatch, few):
    monkeypatch.setattr(history, "CONTESTED", few)
    rng = random.Random(31)
    # a hot key, chains and random ties
    rows = [(i, k) for i in range(300) for k in {rng.choice([0, 1000 + i, 1000 + i // 3]), 2000 + (i + 1) // 2, rng.randint(5000, 5200)}]
    held, want = {}, set()
    for i in range(300):
        mine = [k for j, k in rows if j == i]
        hits = [held[k] for k in mine if k in held]
        if hits:
            want.add((i, min(hits)))
        else:
            held.update(dict.fromkeys(mine, i))
    df = spark.createDataFrame([(i, k, -k) for i, k in rows], "id long, point long, check long")
    assert {(r.duplicate_id, r.accepted_id) for r in history._first_wins(df).collect()} == want
