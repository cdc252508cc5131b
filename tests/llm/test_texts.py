"""Encoding, packing and languages."""

import random
from collections import Counter, defaultdict

import pytest

tiktoken = pytest.importorskip("tiktoken")

from siteweave.llm import languages as L  # noqa: E402
from siteweave.llm import packing  # noqa: E402
from siteweave.llm.tokenizer import PATTERN, Encoder, encode_documents, read_ranks  # noqa: E402

TEXTS = [
    None, "", " ", "Hello world", "it's we'll  \n\n x", "<|endoftext|>", "a" * 3000, "ab" * 2000, "x" + " " * 2000 + "y", "東京" * 300, "🔋⚡️" * 40, "é́ ñ", "227.5 MW 8.12.2028", "\r\n", "﻿We could", "\x00\x01",
]


@pytest.fixture(scope="module")
def ranks():
    return read_ranks()


def test_encoder_equals_the_library(ranks):
    library, own, rng = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), Encoder(ranks), random.Random(1)
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice("etaoinshr") for _ in range(2000)), "".join(chr(rng.randrange(32, 0x2FFF)) for _ in range(2000)), "".join(rng.choice(" abcdéß.,'0\n") for _ in range(3000))]
    for text in texts:
        assert own.encode(text) == library.encode_ordinary(text)
        assert library.decode(own.encode(text)) == text


def test_forced_cuts_are_certain(ranks):
    own = Encoder(ranks)
    for token in list(ranks)[::997]:
        assert all(own.inside[a, b] for a, b in zip(token, token[1:]))
    assert not own.inside.all()


def test_documents(spark, ranks):
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(TEXTS)] + [(3, "Hello world", "k")], "doc_id long, text string, key string")
    got = sorted((r["doc_id"], list(r["ids"])) for r in encode_documents(df).collect())
    assert got == sorted([(i, library.encode_ordinary(t or "")) for i, t in enumerate(TEXTS)] + [(3, library.encode_ordinary("Hello world"))])
    assert {r["doc_id"]: r["n_tokens"] for r in encode_documents(df, counts_only=True).collect()} == {i: len(x) for i, x in got}
    assert encode_documents(df.limit(0)).isEmpty()


# --- packing


def test_fullest_combination_against_all_subsets():
    rng = random.Random(3)
    for _ in range(60):
        items = [rng.randrange(1, 21) for _ in range(rng.randrange(1, 9))]
        chosen = packing.fullest_combination(Counter(items), 20)
        rest = list(items)
        rest.remove(max(items))
        sums = {0}
        for x in rest:
            sums |= {s + x for s in sums}
        want = max(s for s in sums if s + max(items) <= 20) + max(items)
        assert sum(k * n for k, n in chosen.items()) == want and not Counter(chosen) - Counter(items) and chosen[max(items)] >= 1


def test_pack(spark):
    rng = random.Random(8)
    sizes = [rng.randrange(1, 60) for _ in range(300)] + [10] * 150 + [100, 101, 250, 300, 0, -3, None]
    df = spark.createDataFrame([(i, n, "x") for i, n in enumerate(sizes)], "id int, n long, container string")
    got = packing.pack(df, "id", "n", 100).collect()
    fill, seen = defaultdict(int), defaultdict(list)
    for r in got:
        fill[r["container"]] += r["length"]
        seen[r["id"]].append((r["piece"], r["first"], r["length"]))
    assert max(fill.values()) <= 100 and sorted(fill) == list(range(len(fill)))
    total = sum(n for n in sizes if n and n > 0)
    assert sum(fill.values()) == total and len(fill) <= -(-total // 100) + 1
    for i, n in enumerate(sizes):
        if n and n > 0:
            pieces = sorted(seen[i])
            assert [p[1] for p in pieces] == list(range(0, n, 100)) and sum(p[2] for p in pieces) == n
        else:
            assert i not in seen
    assert packing.pack(df.limit(0), "id", "n", 100).isEmpty()


# --- languages

SENTENCES = {
    "en": ["The utility has agreed to serve the new substation, and the line should be ready in 1990.", "Nobody on the call measured the footprint twice and came to {n} square feet.", "Residents of the town told the board that the noise can be heard at night."],
    "es": ["El turno de noche guarda una copia de cada lectura del contador desde {n}.", "La oficina de catastro cree que la segunda línea nunca llegó a conectarse.", "Los vecinos dijeron a la junta que el ruido se oye también durante la noche."],
    "fr": ["Le service des impôts a payé d'avance la redevance pour {n} places de parking.", "On ne sait pas si les moteurs concernent tout le campus ou seulement la première tranche.", "L'équipe de nuit n'a pas reçu la lettre qui a été postée en avril."],
    "de": ["Der Prüfer fragte, warum {n} Rechnungen doppelt gebucht wurden, und niemand konnte es sagen.", "In diesem Monat wurde keine Störung gemeldet, obwohl der Alarm ausgelöst hat.", "Wer nur den Zaun sieht, ahnt nicht, wie viel Strom durch diesen Hof fließt."],
    "pt": ["Não conseguimos saber quem é o dono do terreno, e por isso a ficha continua aberta.", "O novo dono do lote mediu a planta duas vezes e chegou a {n} pés quadrados.", "Os moradores disseram à comissão que o ruído também se ouve durante a noite."],
    "it": ["Non è chiaro se i motori si riferiscano a tutto il campus oppure solo alla prima fase.", "Il revisore ha chiesto perché {n} fatture erano state registrate due volte.", "La ditta non ha ricevuto la lettera che è stata spedita in primavera."],
}


def corpus(n=40):
    rng = random.Random(2)
    out = []
    for code, sentences in SENTENCES.items():
        for k in range(n):
            text = " ".join(rng.choice(sentences).replace("{n}", str(rng.randrange(2000))) for _ in range(3))
            out.append((len(out), text, code if k % 8 else "en"))
    return out


def test_labels(spark):
    from pyspark.sql import functions as F

    data = {"en_GB": "en", "ENGLISH": "en", " eng ": "en", "pt-BR": "pt", "Português": "pt", "fra": "fr", "German": "de", "it_CH": "it", "es-MX": "es", "xx": None, "und": None, "": None, "??": None, None: None}
    df = spark.createDataFrame([(k,) for k in data], "l string")
    assert {r["l"]: r["x"] for r in df.select("l", L.label_language(F.col("l")).alias("x")).collect()} == data


def test_forward_backward_against_all_paths():
    import itertools

    import numpy as np

    rng = np.random.default_rng(0)
    scores, move, start = rng.normal(size=(1, 4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    weight = {p: np.exp(start[p[0]] + sum(scores[0, t, y] for t, y in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:]))) for p in itertools.product(range(3), repeat=4)}
    total = sum(weight.values())
    got, expected = L.forward_backward(scores, np.array([4]), move, start)
    for t in range(4):
        for y in range(3):
            assert got[0, t, y] == pytest.approx(sum(w for p, w in weight.items() if p[t] == y) / total)
    for a in range(3):
        for b in range(3):
            assert expected[a, b] == pytest.approx(sum(w * sum(x == (a, b) for x in zip(p, p[1:])) for p, w in weight.items()) / total)


#: Sentences of shared words, none of them in the fitted corpus below.
HELD_OUT = {
    "en": ["The meeting of the board is on the first day of the month.", "It may be that all of the doors were shut by then."],
    "es": ["La puerta de la sala se abre solo durante la visita.", "Las obras de la nave empiezan en cuanto llegue el permiso."],
    "fr": ["Le conseil de la ville se prononcera sur la demande de la société.", "La porte de la salle ne se ferme pas."],
    "de": ["Die Tür zu der Halle ist in der Nacht nicht offen.", "Man hat es dem Rat im Mai gesagt."],
    "pt": ["Os lotes a leste de Santa Maria são de uso industrial.", "Os visitantes têm de se apresentar no portão antes de entrar."],
    "it": ["La porta della sala si apre soltanto di giorno.", "La domanda di allaccio non è stata ancora accolta."],
}


def bare(text):
    return text.translate(str.maketrans(L.FOLD_FROM, L.FOLD_TO))


@pytest.mark.parametrize("change", [str, str.upper, bare, lambda t: bare(t).upper()])
def test_held_out_sentences(change):
    data = [(text, code) for _, text, code in corpus(120)]
    field = L.fit_field(*map(list, zip(*data)))
    tried = [(code, change(s)) for code, sentences in HELD_OUT.items() for s in sentences]
    found = [field.marginals([field.number(L.words_of(s))]) for _, s in tried]
    assert [L.LANGUAGES[int(x.sum(0).argmax())] for x in found] == [code for code, _ in tried]


def test_labels_outweigh_shared_words_and_yield_to_evidence():
    fr, es, pt = LANG["fr"], LANG["es"], LANG["pt"]
    documents = [[L.words_of(s) for s in HELD_OUT[code]] for code in ("fr", "pt", "es")]
    assert L._sentence_labels(documents, [fr, pt, es]) == [[fr, fr], [pt, pt], [es, es]]
    # Twenty documents in Spanish show that the one labelled French is none.
    documents = [[L.words_of(s) for s in SENTENCES["es"]]] * 20 + [[L.words_of(s) for s in SENTENCES["fr"]]] * 20 + [[L.words_of(SENTENCES["es"][1])]]
    assert L._sentence_labels(documents, [es] * 20 + [fr] * 21)[-1] == [es]


LANG = {code: k for k, code in enumerate(L.LANGUAGES)}


def test_languages(spark):
    data = corpus()
    mixed = [(900, "The line should be ready and the file says nothing more. «Os lotes são de uso industrial, e não há registo de nenhuma venda.» Nobody on the call has paid the fee for this.", "en"), (901, "NAO CONSEGUIMOS SABER QUEM E O DONO DO TERRENO, E POR ISSO A FICHA CONTINUA ABERTA.", None), (902, "| 36 | G42 1700 kW 46.4981, -81.7396 https://docs.example/a/b?the=of kW kW", "en"), (903, "", None), (904, None, "fr"), (905, "  \n ", "fr"), (906, "The utility\nhas agreed to serve\nthe new substation in 1990.\n\nLos vecinos dijeron que el ruido se oye durante la noche.", "de"), (907, SENTENCES["de"][1] + " " * 20_000 + SENTENCES["it"][0], "it")]
    short = [(910, "Nobody called. ### 12 kW. The file says nothing.", "en"), (911, "12 kW. Nobody called. kW kW kW.", "en")]
    df = spark.createDataFrame([(*r, "x") for r in data + mixed + short], "doc_id long, text string, lang string, words string")
    got, whole, spans = defaultdict(list), defaultdict(list), defaultdict(list)
    for r in L.sentence_languages(df).orderBy("doc_id", "sentence").collect():
        got[r["doc_id"]].append(r["lang"])
        whole[r["doc_id"]].append(r["whole"])
        spans[r["doc_id"]].append((r["sentence"], r["first"], r["length"], r["words"]))
        assert 0 < r["confidence"] <= 1
    truth = [code for code in SENTENCES for _ in range(40)]
    right = sum(lang == truth[i] for i in range(240) for lang in got[i])
    assert right / sum(len(got[i]) for i in range(240)) > 0.99
    assert got[900] == ["en", "pt", "en"] and got[901] == ["pt"] and got[906] == ["en", "es"] and got[907] == ["de", "it"]
    assert not any(got[i] for i in (902, 903, 904, 905))
    # Short segments have rows too, marked as no whole sentences; units alone have none.
    assert got[910] == ["en", "en"] and whole[910] == [False, True] and got[911] == ["en"] and whole[911] == [False]
    assert spans[910] == [(0, 0, 14, 2), (1, 25, 23, 4)] and spans[911] == [(0, 6, 15, 2)]


def test_languages_without_labels(spark):
    df = spark.createDataFrame([(1, SENTENCES["fr"][1], None)], "doc_id long, text string, lang string")
    assert [r["lang"] for r in L.sentence_languages(df).collect()] == ["fr"]
    assert L.sentence_languages(df.limit(0)).isEmpty()
