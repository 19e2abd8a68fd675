"""Problems 1 to 7 on hand-written acts: rules, nulls, empty tables, repeats, ties, clashing columns."""

import pytest

from actaflow.llm import canonical_list, encoding_repair, format_copies, name_variants, page_noise, survivors, truncation
from actaflow.llm.queries import QUERIES
from actaflow.runtime import table

COLUMNS = ("data_publicacao", "nome", "id_funcional", "assinante", "cargo_assinante", "nome_parse_confiavel", "cargo", "orgao", "trecho", "fonte_url", "arquivo_markdown", "id", "key", "n", "valor", "campo")
SCHEMA = "linha_csv bigint, " + ", ".join(f"`{c}` string" for c in COLUMNS)


@pytest.fixture
def acts(spark):
    def make(*rows):
        return spark.createDataFrame([(i, *[r.get(c, "") for c in COLUMNS]) for i, r in enumerate(rows, 1)], SCHEMA)

    return make


def rows(df):
    return sorted(tuple(r) for r in df.collect())


LONG = "Fica nomeada ANA LIMA para o cargo. " * 3000


# ---- problem 1


BODY = ("Processo nº 2026.{i}. NOMEAR ANA LIMA, matrícula {i}, para exercer o cargo de Assessor na Secretaria de Estado de Obras. O termo será assinado perante a chefia imediata, em duas vias. Vigência imediata.",
        "Portaria nº {i}, de 3 de maio. EXONERAR, a pedido, RUI REIS do cargo de Coordenador.\nDê-se ciência e arquive-se.\nBarra do Quati, 3 de maio de 2026. Eva Prado\nDiretor-Geral",
        "CARGO: Assessor | PROCESSO - {i} | MOTIVO : a pedido | SERVIDOR = RUI REIS.", "O edital saiu à página {i} da Gazeta Oficial nº 31{i}, caderno de concursos. Conforme a página {i} do processo, não há impedimento à posse.")


def clean_acts(n):
    return [{"trecho": BODY[i % 4].format(i=i + 100), "nome": "ANA LIMA"} for i in range(n)]


def test_page_traces(spark, acts):
    clean = BODY[0].format(i=7)
    cases = [clean, clean.replace("exercer", "exer-\ncer"), clean.replace("Assessor", "A s s e s s o r"), clean.replace("para", "~ para"), clean.replace("cargo", "c@rgo"), clean.replace(" exercer", "\n## Pagina 12\nexercer"),
             clean.replace("para", "Pág. 3/40 para"), clean.replace("assinado", "assi- nado"), None, "", LONG, clean.replace(" ", "\n")]
    df = acts(*clean_acts(300), *[{"trecho": t} for t in cases])
    assert [r[0] - 300 for r in rows(page_noise.scanned(df))] == [2, 3, 4, 5, 6, 7, 8]
    fixed = {i - 300: t for i, t in rows(page_noise.repaired(df)) if i > 300}
    assert {i: t for i, t in fixed.items() if i < 9 and t != clean} == {}
    assert fixed[9] is None and fixed[10] == "" and fixed[11] == LONG
    assert rows(page_noise.scanned(df.limit(0))) == []


def test_every_excerpt_is_labelled(spark, acts):
    """Heads without digits, at either end or of one case, and references in small letters count as others do."""
    clean = BODY[0].format(i=7)
    cases = [clean, clean.replace(" exercer", "\nDIÁRIO OFICIAL\nexercer"), clean.replace("cargo de", "cargo de pág. 12"), clean.replace("perante", "peran-\tte")]
    df = acts(*clean_acts(300), *[{"trecho": t} for t in cases])
    _, masks, _ = page_noise.evidence(df)
    got = {r.linha_csv - 300: list(r.mascaras) for r in masks.where("linha_csv > 300").collect()}
    assert got == {i: page_noise.features(t) for i, t in enumerate(cases, 1)}
    assert (302,) in rows(page_noise.scanned(df)) and (301,) not in rows(page_noise.scanned(df))


def test_guards_lose_no_feature():
    import random

    import pyarrow as pa

    rng, added = random.Random(5), ["\n", "\r\n", "\f", "   ", "\t", "\u2003", "- ", "¬ ", "\xad", "*", "|", "'", "°.", "@", "c,a", "0a", " a b c d", " A B C D", "Pág. 3/40", "p. 12", "2 RIO, SÁBADO", "código ab12cd34", "OBRA: a", "²"]
    texts = ["".join(x for c in BODY[k % 4].format(i=k) for x in (c, rng.choice(added) if rng.random() < 0.02 else "")) for k in range(400)]
    for text, may in zip(texts, page_noise.guards(pa.array(texts)).tolist(), strict=True):
        assert page_noise.pieces(text, may) == page_noise.pieces(text) and page_noise.features(text, may=may) == page_noise.features(text)


def test_words_are_judged_by_counts(spark, acts):
    good = [{"trecho": f"NOMEAR para a Secretaria de Estado {i}."} for i in range(200)]
    df = acts(*good, {"trecho": "NOMEAR para a Sccretaria de Estado."}, {"trecho": "NOMEAR para a Secretariade Estado."}, {"trecho": "NOMEAR para a Sccretaria.", "orgao": "Sccretaria"})
    assert [(r[0], r[1]) for r in rows(page_noise.evidence(df)[0].select("linha_csv", "certa"))] == [(201, "secretaria"), (202, "secretaria de")]


def test_labels_decide(spark, acts, monkeypatch):
    df = acts(*clean_acts(300), {"trecho": BODY[0].replace("chefia imediata", "chefia ime-\ndiata")})
    assert rows(page_noise.scanned(df)) == [(301,)]
    blind = page_noise.Labeller()
    blind.weight = {"any": [0.0, 1.0, 0.0, 0.0]}  # everything is body
    monkeypatch.setattr(page_noise, "fitted", lambda *_: blind)
    assert rows(page_noise.scanned(df)) == []


def test_recall_on_planted_damage(spark, base):
    """Excerpts the model wasn't fitted on, with damage planted by the same templates of heads and glyphs: labels by line."""
    import random

    df = table(spark, base, "doeg_2026")
    words, masks, counts = page_noise.evidence(df)
    model, known = page_noise.fitted(df, words, counts), {r.palavra: r.n for r in counts.collect()}
    damaged = {r.linha_csv for r in page_noise._labels(words, masks, model).collect()}
    rng, hit, false, n = random.Random(99), 0, 0, 0
    for r in table(spark, base.replace("sf0.001", "sf0.01"), "doeg_2026").where("linha_csv % 10 = 3").collect():
        made, labels, seen = page_noise.plant(r.trecho, rng, known)
        if set(labels) == {"body"}:
            continue
        got = model.best([page_noise.names_of(m, w) for m, w in zip(page_noise.features(made), page_noise.words_in(made, seen), strict=True)])
        n, hit = n + 1, hit + any(x != "body" for x in got)
        false += sum(a != b for a, b in zip(got, labels, strict=True)) / len(labels)
    assert hit / n > 0.95 and false / n < 0.1 and len(damaged) < 0.1 * df.count()


def test_line_labels(spark, base):
    df = table(spark, base, "doeg_2026")
    words, _, counts = page_noise.evidence(df)
    text = "Fica nomeada a servidora para o cargo vago nesta data\n\x0c12   Jornal Oficial\nque continua aqui com o texto da portaria e depois aca-\nba no fim dela."
    assert page_noise.fitted(df, words, counts).best([page_noise.names_of(m, []) for m in page_noise.features(text)]) == ["body", "header", "break", "body"]


# ---- problem 2


def test_survivors(spark, acts):
    df = acts(
        {"nome": "A. LIMA", "nome_parse_confiavel": "sim", "data_publicacao": "2026-01-01", "orgao": "X"},
        {"nome": "ANA MARIA DE LIMA", "nome_parse_confiavel": "nao", "data_publicacao": "2026-03-01", "orgao": "X"},
        {"nome": "ANA LIMA", "nome_parse_confiavel": "sim", "data_publicacao": "2026-01-01", "orgao": "X"},
        {"nome": "ANA LIMA", "nome_parse_confiavel": "sim", "data_publicacao": "2026-02-01", "orgao": "X"}, {"nome": None, "nome_parse_confiavel": None, "data_publicacao": None, "orgao": None})
    groups = spark.createDataFrame([(7, 1), (7, 2), (7, 3), (7, 4), (7, 4), (8, 5), (9, 99), (None, 1)], "grupo_id bigint, linha_csv bigint")
    assert rows(survivors.contested_fields(groups, df)) == [(7, "nome", 3)]
    assert rows(survivors.surviving_records(groups, df)) == [(7, "ANA LIMA", "", "X"), (8, "", "", "")]
    assert rows(survivors.contested_fields(groups.limit(0), df)) == []


def test_unreadable_dates_are_oldest_and_votes_choose(spark, acts):
    old = {"nome": "EVA LIMA", "nome_parse_confiavel": "sim", "data_publicacao": "31/12/2025", "cargo": "Chefe"}
    df = acts(old, {**old, "nome": "ANA LIMA", "data_publicacao": "2026-05-01", "cargo": "Diretor"}, {**old, "cargo": "chefe", "data_publicacao": "2026-04-30"}, {**old, "cargo": "Chefe", "data_publicacao": "2024-05-01"})
    groups = spark.createDataFrame([(7, 1), (7, 2), (8, 2), (8, 3), (8, 4), (9, 2), (9, 4)], "grupo_id bigint, linha_csv bigint")
    assert [r for r in rows(survivors.contested_fields(groups, df)) if r[0] == 7] == [(7, "nome", 2)]
    # Two votes of which one is as new beat one; one vote four half-lives older loses.
    assert [r[2] for r in rows(survivors.voted_fields(groups, df)) if r[1] == "cargo"] == ["Diretor", "chefe", "Diretor"]


# ---- problem 3


def test_format_copies(spark, acts):
    a = {"nome": "ANA LIMA", "trecho": "CARGO: Assessor; PROCESSO: 100/2026; MOTIVO: a pedido."}
    df = acts(a, {**a, "nome": " ana  lima."}, {**a, "trecho": '"PROCESSO = 100/2026 | MOTIVO - a pedido | CARGO = ASSESSOR."'}, {**a, "trecho": a["trecho"].replace("100", "101")},
              {**a, "trecho": "PROCESSO: 001/2026; CARGO: Assessor; MOTIVO: a pedido."}, a, {"nome": None, "trecho": None}, {"nome": "", "trecho": ""}, {**a, "data_publicacao": "2026-01-01"})
    assert rows(format_copies.surplus_pairs(df)) == [(1, 2), (1, 3), (1, 6), (7, 8)]
    assert [(r.linha_csv, r.copias) for r in format_copies.collapse_copies(df).orderBy("linha_csv").collect()] == [(1, 4), (4, 1), (5, 1), (7, 2), (9, 1)]
    assert rows(format_copies.surplus_pairs(df.limit(0))) == []


def test_copies_equal_brute_force(spark, base):
    import re

    df = table(spark, base, "doeg_2026").toPandas()
    flat = lambda x: re.sub(r"[\W_]+", "", x.upper().lower())
    other = [c for c in df.columns if c not in ("linha_csv", "nome", "cargo", "orgao", "trecho")]
    key = df.apply(lambda r: (*[r[c] for c in other], flat(r.nome), flat(r.cargo), flat(r.orgao), "".join(sorted(flat(r.trecho)))), axis=1)
    expect = sorted((min(g), x) for _, g in df.groupby(key).linha_csv for x in g if x != min(g))
    assert rows(QUERIES["p3_found"](spark, base)) == expect


# ---- problem 4


def test_name_channel():
    full = "FLAVIO PEDRO CEDURONHA DROBULHEDO".split()
    assert name_variants.channel("F P CEDURONHA DROBULHEDO".split(), full) is not None
    assert name_variants.channel("FLAVIO CEDURONHA DROBULHEDO".split(), full) is not None
    assert name_variants.channel("PEDRO CEDURONHA DROBULHEDO".split(), full) is None
    assert name_variants.channel([*full, "FILHO"], full) is None
    assert name_variants.channel("LEO QUOLICHEL ROBADAL".split(), "LEANDRO QUOLICHEL ROBADAL".split()) is not None
    assert name_variants.channel("ANGELA DROBAPEL QUEMIRONHA".split(), "VALDIR DROBAPEL QUEMIRONHA".split()) is None


def test_name_variants(spark, acts):
    names = ["JOÃO FOVURDIM LORUNÇA"] * 5 + ["J. FOVURDIM LORUNÇA", "FOVURDIM LORUNÇA, JOÃO", "MARIA FOVURDIM LORUNÇA", "JOÃƒO FOVURDIM LORUNÃ‡A", "CONFORME QUADRO ANEXO", None, ""]
    got = rows(name_variants.variant_pairs(acts(*[{"nome": n} for n in names])))
    assert got == [("nome", "FOVURDIM LORUNCA JOAO", "J FOVURDIM LORUNCA"), ("nome", "FOVURDIM LORUNCA JOAO", "JOAO FOVURDIM LORUNCA"), ("nome", "J FOVURDIM LORUNCA", "JOAO FOVURDIM LORUNCA")]
    assert name_variants.spelling(" José-d'Ávila 2º ") == "JOSE D AVILA O"
    assert rows(name_variants.variant_pairs(acts().limit(0))) == []


def test_every_accepted_pair_of_forms_meets(spark, base):
    pairs = [("ZE SILVA", "JOSE SILVA"), ("ANA DROBAPLE", "ANA DROBAPEL"), ("ANA RDOBAPEL", "ANA DROBAPEL"), ("ANA DRBOAPEL", "ANA DROBAPEL"), ("ANA XROBAPEL", "ANA DROBAPEL"), ("ANA ROBAPEL", "ANA DROBAPEL"), ("ANA DDROBAPEL", "ANA DROBAPEL"),
             ("CONC DROBAPEL", "CONCEICAO DROBAPEL"), ("JP SILVA", "JOAO PEDRO SILVA"), ("A DROBAPEL", "ANA MARIA DROBAPEL"), ("ZE SLIVA LIMA FILHO", "JOSE SILVA ROSA LIMA FILHO"), ("F P SOUZA", "FLAVIO PEDRO SOUZA")]
    for a, b in pairs:
        met = bool(name_variants.probe_keys(a.split()) & name_variants.offer_keys(b.split()))
        assert met or name_variants.channel(a.split(), b.split()) is None, (a, b)
    written = name_variants.forms(name_variants.spellings(table(spark, base, "doeg_2026"), ("nome", "assinante")))
    words = [(list(r.ordem), name_variants.probe_keys(r.ordem), name_variants.offer_keys(r.ordem)) for r in written.select("ordem").distinct().collect()]
    lost = [(f, c) for f, probes, _ in words for c, _, offers in words if not probes & offers and set(f) & set(c) and name_variants.channel(f, c) is not None]
    assert lost == []


def test_nickname_and_one_surname(spark, acts):
    names = ["JOSE SOLVURDIM"] * 5 + ["ZE SOLVURDIM", "ANA DROBAPEL", "ANA DROBAPEL", "ANA DROBAPEL", "ANA XROBAPEL"]
    got = {r.grafia: r.entidade for r in name_variants.entities(acts(*[{"nome": n} for n in names])).collect()}
    assert got["ZE SOLVURDIM"] == got["JOSE SOLVURDIM"] and got["ANA XROBAPEL"] == got["ANA DROBAPEL"] and len(set(got.values())) == 2


def test_typos_between_two_words_and_initial_e(spark, acts):
    others = [f"{g} {s}{t} ROLALUZ" for g in ("JOAO", "JOANA", "ELISA", "RUI") for s in ("BAR", "DOL", "FEZ", "GOT", "LAT") for t in ("IMUL", "ADUR", "OSEN", "UVAT")]
    names = [*others, "JOANA PELUMIL ZARANOR", "JOAA PELUMIL ZARANOR", "ELISA PELUMIL ZARANOR", "E PELUMIL ZARANOR", "REGISTRE SE", "DA CIDADE DE", "PARA COMPOR A COMISSAO"]
    df = acts(*[{"nome": n} for n in names], {"assinante": "COMISSAO DE POSSE ROLALUZ"}, {"assinante": "COM DE POSSE ROLALUZ"})
    got = rows(name_variants.variant_pairs(df))
    assert got == [("assinante", "COM DE POSSE ROLALUZ", "COMISSAO DE POSSE ROLALUZ"), ("nome", "E PELUMIL ZARANOR", "ELISA PELUMIL ZARANOR"), ("nome", "JOAA PELUMIL ZARANOR", "JOANA PELUMIL ZARANOR")]


def test_parents_in_rings_and_long_chains(spark):
    parents = {"A": "B", "B": "A", "C": "A", "D": "E", "E": "F", "F": "D", **{f"x{i}": f"x{min(i + 1, 20)}" for i in range(21)}}
    df = spark.createDataFrame([("nome", f, p, 9 if f in "AE" else 1) for f, p in parents.items()], "campo string, forma string, pai string, n bigint")
    got = {r.forma: r.raiz for r in name_variants.roots(df).collect()}
    assert got == {"A": "A", "B": "A", "C": "A", "D": "E", "E": "E", "F": "E", **{f"x{i}": "x20" for i in range(21)}}


def test_doubled_letter_in_a_surname(spark, acts):
    names = ["TEREZA DEDAPEL QUADUMAR"] * 12 + ["TEREZA DEDAPEEL QUADUMAR"] * 3
    got = {r.grafia: r.entidade for r in name_variants.entities(acts(*[{"nome": n} for n in names])).collect()}
    assert len(got) == 2 and len(set(got.values())) == 1


def test_no_join_of_names_is_broadcast(spark, base, monkeypatch):
    """Their sides are many times their files, which Spark goes by: the driver would run out of memory on large tables."""
    plans, cut = {}, name_variants.cut

    def seen(df, label="cut"):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return cut(df, label)

    monkeypatch.setattr(name_variants, "cut", seen)
    plans["pairs"] = name_variants.variant_pairs(table(spark, base, "doeg_2026"))._jdf.queryExecution().executedPlan().toString()
    assert {k for k, p in plans.items() if "SortMergeJoin" in p} >= {"readings", "forms", "links", "chains", "entities", "pairs"}
    assert [k for k, p in plans.items() if "Broadcast" in p and k != "spellings"] == []


# ---- problem 5


def test_truncation(spark, acts):
    whole = [{"trecho": f"Processo {i}. O termo será assinado perante a chefia imediata. Dê-se ciência e arquive-se.", "orgao": "Secretaria de Estado de Obras", "fonte_url": "https://a.example/1"} for i in range(80)]
    df = acts(*whole, {"trecho": "Processo 5. O termo será assinado perante a che", "orgao": "Secretaria de Est"}, {"trecho": None, "orgao": ""}, {"trecho": "xyz", "orgao": "Única"})
    assert rows(truncation.truncated(df)) == [(81, "orgao"), (81, "trecho")]
    rates = {(r.fonte, r.campo): (r.valores, r.cortados) for r in truncation.truncation_rates(df).collect()}
    assert rates["a.example", "trecho"] == (80, 0) and rates["unknown", "trecho"] == (2, 1)
    assert rows(truncation.truncated(df.limit(0))) == []


def test_values_often_cut_at_one_place(spark, acts):
    whole, short = "Secretaria de Estado de Agricultura Familiar", "Secretaria de Estado de Agricultura Fami"
    values = [whole] * 60 + [short] * 90 + [whole + "e"] + [whole + ", em Quati"] * 5
    df = acts(*[{"orgao": v, "fonte_url": f"https://{'b' if v == short else 'a'}.example/1"} for v in values])
    assert rows(truncation.truncated(df)) == [(i, "orgao") for i in range(61, 151)]
    rates = {(r.fonte, r.campo): (r.valores, r.cortados) for r in truncation.truncation_rates(df).collect()}
    assert rates["b.example", "orgao"] == (90, 90) and rates["a.example", "orgao"] == (66, 0)


def test_window_hashes_agree_with_substrings():
    import numpy as np

    text = "abracadabra"
    up, down = truncation._powers(20)
    p = truncation._points(text)
    sums = truncation.running_sums(p, up)
    for n in (1, 3, 5, 8):
        h = truncation.window_hashes(p, np.arange(n, len(p) + 1), n, sums, down)
        grams = [text[i : i + n] for i in range(len(text) - n + 1)]
        assert all((a == b) == (x == y) for a, x in zip(grams, h, strict=True) for b, y in zip(grams, h, strict=True))


@pytest.mark.parametrize("most", [1 << 25, 40])
def test_contexts_equal_brute_force(spark, acts, monkeypatch, most):
    """Counts of every context, in one pass and in several, and across the seams of segments."""
    monkeypatch.setattr(truncation, "MOST_CONTEXTS", most)
    monkeypatch.setattr(truncation, "SEGMENT", 64)
    texts = ["o termo será assinado perante a chefia", "assinado perante a chefia imediata e o termo", "a chefia", "", "termo"] * 3
    df = acts(*[{"trecho": t} for t in texts])
    ends = spark.createDataFrame([("trecho", t[-20:], 1) for t in set(texts) if t], "campo string, fim string, n bigint")
    suffixes = ends.mapInPandas(truncation._suffix_rows, "campo string, fim string, ordem int, hash bigint, n bigint")
    names = {(r.ordem, r.hash): r.fim[-r.ordem :] for r in suffixes.collect()}
    got = {(r.ordem, names[r.ordem, r.hash]): (r.total, r.letras) for r in truncation.contexts(df, ("trecho",), suffixes).collect() if (r.ordem, r.hash) in names}
    for (n, gram), found in got.items():
        at = [(t, i) for t in texts for i in range(len(t) - n + 1) if t[i : i + n] == gram]
        assert found == (len(at), sum(t[i + n : i + n + 1].isalpha() for t, i in at)), gram
    assert got.keys() == {(n, gram) for (n, _), gram in names.items()}


def test_thresholds_are_fitted_on_places_in_all_values(spark, acts):
    from collections import Counter

    texts = ["o termo será assinado perante a chefia", "assinado perante a chefia imediata e o termo", "a chefia", "termo"] * 1600
    known = {t[-k:] for t in texts for k in truncation.ORDERS if len(t) >= k}
    want = Counter()
    for t in texts:
        for i in range(truncation.ORDERS[0], len(t)):
            want[max((t[i - k : i] for k in truncation.ORDERS if k <= i and t[i - k : i] in known), key=len, default="")] += 1
    del want[""]
    places = truncation.end_scores(acts(*[{"trecho": t} for t in texts]), ("trecho",))[2]
    assert {r.fim[-r.ordem :]: r.n for r in places.where("n > 0").collect()} == want and sum(want.values()) > 3000


def test_a_second_heap_of_complete_ends_is_no_heap_of_cuts(spark):
    heaps = [(-2.5, 500), (1.0, 500), (-7.0, 5)]
    ends = spark.createDataFrame([(i, "trecho", f"fim {h}.", "pt") for h, n in heaps for i in range(n)], "linha_csv bigint, campo string, fim string, lingua string")
    scores = spark.createDataFrame([("trecho", f"fim {h}.", h, False) for h, _ in heaps], "campo string, fim string, log_odds double, na_palavra boolean")
    planted = spark.createDataFrame([("trecho", f"fim {h}.", "pt", h) for h in (-2.5,) * 60 + (-7.0,) * 40], "campo string, fim string, lingua string, log_odds double")
    assert -7 < truncation.thresholds(ends, scores, planted)["trecho", "pt", True] <= -2.5


def test_planted_cuts_are_found(spark):
    """Cuts planted in values of one table are found at the same thresholds (held out from those that fitted them)."""
    df = table(spark, "/root/testdata/sf0.01", "doeg_2026").select("linha_csv", "trecho", "orgao", "fonte_url")
    cut_ = df.where("linha_csv % 50 = 7 and length(trecho) > 150").selectExpr("linha_csv + 1000000 AS linha_csv", "substring(trecho, 1, 60 + linha_csv % 80) AS trecho", "'' AS orgao", "fonte_url")
    found = {r.linha_csv for r in truncation.truncated(df.unionByName(cut_)).where("campo = 'trecho'").collect()}
    planted = {r.linha_csv for r in cut_.collect()}
    assert len(planted & found) / len(planted) > 0.9 and len(found - planted) < 0.08 * df.count()


# ---- problem 6


def test_canonical_list(spark, acts):
    agencies = spark.createDataFrame([(1, "Secretaria de Estado da Saúde Coletiva", "SESAC", "Departamento de Higiene"), (2, "Secretaria de Estado da Saúde Animal", "SESAN", None), (3, "Instituto de Águas Termais", "INATER", None)], "orgao_id bigint, nome_oficial string, sigla string, nome_anterior string")
    roles = spark.createDataFrame([(1, "Secretário de Estado", 4), (2, "Reitor", 7), (3, "Pró-Reitor de Extensão", 7)], "cargo_id bigint, cargo_oficial string, categoria int")
    typed = [("Sec. de Est. da Saude Coletiva", "Secretária de Estado em exercício"), ("SESAN/GO", "Reitora"), ("Gerência de Pessoal da Secretaria de Estado da Saúde Animal", "Pro-Reitor De Extensao"), ("Rádio Clube de Água Turva", "Fiador"),
             ("Instituto de Águas Termais", "Secretário de Estado da Instituto de Águas Termais"), ("  ", None), ("Secretaria de Estado da Saúde Colet", "Reitor, respondendo"), ("Departamento de Higiene, em Porto", "Reitor")]
    got = rows(canonical_list.mapped_values(acts(*[{"orgao": o, "cargo_assinante": c} for o, c in typed]), agencies, roles))
    assert [r for r in got if r[1] == "orgao"] == [(1, "orgao", 1), (2, "orgao", 2), (3, "orgao", 2), (4, "orgao", 0), (7, "orgao", 1), (8, "orgao", 1)]
    assert [r for r in got if r[1] != "orgao"] == [(1, "cargo_assinante", 1), (2, "cargo_assinante", 2), (3, "cargo_assinante", 3), (4, "cargo_assinante", 0), (5, "cargo_assinante", 1), (7, "cargo_assinante", 2)]
    assert {r[2] for r in rows(canonical_list.mapped_values(acts({"orgao": "x", "cargo_assinante": "y"}), agencies.limit(0), roles.limit(0)))} == {0}


@pytest.mark.parametrize("most", [20_000, 0])
def test_filters_and_keys_lose_no_pair(spark, base, monkeypatch, most):
    """Every word against every list token and every value against every entry gives the same best similarity, broadcast or not."""
    C = canonical_list
    monkeypatch.setattr(C, "MAX_LIST", most)
    entries = C.agency_entries(table(spark, base, "ref_orgaos"))
    values = table(spark, base, "doeg_2026").selectExpr("orgao AS valor")
    got = {r.valor: r.semelhanca for r in C.match_list(values, entries, True).collect()}
    listed = [(r.ref_id, r.tipo, C.plain_text(r.nome), C.tokens_of(r.nome)) for r in entries.collect()]
    tokens = sorted({t for *_, ts in listed for t in ts})
    heads = {ts[0] for _, kind, _, ts in listed if kind != 1}
    known = {}
    for w in {w for v in got for w in C._WORDS.findall(C.fold(v))}:
        exact = next((f for f in C.spellings(w.rstrip(".")) if f in tokens), None)
        mid, end = ([exact], [exact]) if exact else (C.stands_for(w, False, tokens), C.stands_for(w, True, tokens))
        x, pair = w.rstrip("."), []
        for k in range(3, len(x) - 3) if not end and len(x) >= 8 else ():
            pair = pair or next(([f, t] for f in C.spellings(x[:k]) for t in (x[k:], x[k + 1 :]) if f in tokens and t in tokens), [])
        known[w] = {"meio": mid, "fim": end, "partes": pair, "cabeca": bool(heads & set(mid))}
    for v, s in got.items():
        best = 0.0
        for k, (plain, typed, _) in enumerate(C.token_sets(v, known, True)):
            least = C.PART_THRESHOLD if k else C.THRESHOLD
            begun = {ref for ref, _, text, _ in listed if len(plain) >= C.LEAST_BEGINNING and text.startswith(plain) and text != plain}
            for *_, ts in listed:
                common = min(sum(any(a in t for t in typed) for a in ts), sum(bool(set(t) & set(ts)) for t in typed))
                j = common / (len(typed) + len(ts) - common)
                best = max(best, j if j >= least else 0, 1.0 if len(begun) == 1 else 0)
        assert s == pytest.approx(best), v


# ---- problem 7


@pytest.mark.parametrize("codec", ["cp1252", "mac_roman", "cp850", "cp437"])
def test_utf8_read_in_a_legacy_page_comes_back(codec):
    text = "Fica nomeada a servidora Antônia José, função não é cumulável: após três mês, lá está"
    garbled = "".join(bytes([b]).decode(codec) if b < 128 or b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) or codec != "cp1252" else chr(b) for b in text.encode())
    assert encoding_repair.repair(garbled)[:2] == (text, False)
    mixed = text + " e " + garbled
    assert encoding_repair.repair(mixed)[:2] == (text + " e " + text, False)
    nested = text
    for _ in range(6):
        nested = nested.encode().decode("latin-1")
    assert encoding_repair.repair(nested)[0] == text


def test_single_byte_pages_and_loss():
    assert encoding_repair.repair("Conceiзгo Trovumйs", True) == ("Conceição Trovumés", False, "pagina")
    assert encoding_repair.repair("ROS¶NGELA INÒS", True) == ("ROSÂNGELA INÊS", False, "pagina")
    assert encoding_repair.repair("Jos? Lima", True)[1:] == (True, "perda") and encoding_repair.repair("fun\ufffd\ufffdo")[1]


@pytest.mark.parametrize("fine", [
    "Há impedimento? Não consta.", "modelo ‘A’ (§ 3º), ½ turno – ¼ a 25 °C", "FE\u00ad\nBIVEDO", "FAVURÃ-\nES", "LOTAÇ", "de 10 de abril\tde", "IRMÃ “X”", "Compra de 10 € em Genève.",
    "Universität Köln", "MUÑOZ PEÑA", "MÜLLER-SCHÖNE", "ŠIMIĆ", "«à la carte» por £ 5", "Smørrebrød, façade, naïf", "Москва e Αθήνα", "REFORÇO DO SERVIÇO", "D’ÁVILA… e outros", "texto\u00a0com\u00a0blanks"])
def test_sound_text_stays(spark, acts, fine):
    assert encoding_repair.repair(fine, fine.isupper()) == (fine, False, "")


def test_foreign_words_need_the_corpus(spark, acts):
    names = ["LÍVIA MUÑOZ PEÑA", "LÍVIA ROSA QUODIXÃO", "LÍVIA ROSA QUODIXÃO", "LÖVIA ROSA QUODIXÇO", "OTTO MÜLLER-SCHÖNE", "KÖLN ŠIMIĆ", "LUIZ SERVIÇO"]
    texts = ["Está em vigor.", "O termo ser\u00a0 assinado por quem est\u00a0 no cargo.", "Compra de 10 € em Genève.", "Universität Köln.", "Isto está assim.", "x", "O SERVIÇO"]
    got = {(r.id, r.campo): (r.restaurado, r.perdido, r.via) for r in encoding_repair.garbled_values(acts(*[{"nome": n, "trecho": t} for n, t in zip(names, texts, strict=True)])).collect()}
    assert got == {(4, "nome"): ("LÍVIA ROSA QUODIXÃO", False, "pagina"), (2, "trecho"): ("O termo ser\u00a0 assinado por quem está no cargo.", False, "pagina")}


def test_garbled_values(spark, acts):
    df = acts({"trecho": "Resoluï¿½o", "nome": "JOÃO LIMA"}, {"trecho": "Ato nÂº 1.", "nome": "L?VIA"}, {"trecho": None, "nome": ""}, {"trecho": LONG + "nÂº"})
    got = {(r.id, r.campo): r.restaurado for r in encoding_repair.garbled_values(df).collect()}
    assert got[2, "trecho"] == "Ato nº 1." and (2, "nome") in got and got[4, "trecho"] == LONG + "nº" and (1, "nome") not in got and not any(k[0] == 3 for k in got)
    assert rows(encoding_repair.garbled_values(df.limit(0))) == []
