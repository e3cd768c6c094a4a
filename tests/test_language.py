import random

from pairloom.functions import language as L

CAPTIONS = {
    "de": ["Der Hund läuft schnell nach Hause zurück", "Sommerkleid mit Blumen", "Bluse in Übergröße", "Junge Frau mit Fahrrad vor einem alten Haus"],
    "en": ["Red leather shoes for men", "Glass vase with tulips", "evening over the hills", "Two kids building a sand castle"],
    "es": ["Cojín decorativo para el salón", "Una pareja baila en la plaza", "Bolso de mano con cierre"],
    "fr": ["Tapis de souris", "Maison à vendre", "Un petit oiseau sur une branche"],
    "it": ["Vestito rosso elegante", "Un gatto bianco sulla finestra", "Piatto di pasta con basilico"],
    "nl": ["Fietsen in Amsterdam", "Kussen met strepen", "Een klein meisje met een grote hond"],
    "pt": ["Toalha de banho", "Camisa de manga curta azul", "Um menino com uma bola na praia"],
    "ru": ["это кошка", "Red это красный кот"],
    "ja": ["日本の猫です"],
    "zh": ["这是一只猫"],
    "el": ["ένα σκυλί"],
}


def test_short_captions():
    for language, texts in CAPTIONS.items():
        assert L.detect(texts) == [(language, True)] * len(texts), language


def test_what_is_not_reliable():
    texts = ["xyzzy", "qwrtpsdfg hjklm", "", None, "12 34", "IMG_2034.jpg", "DSC 0012", "a", "\x00", "é"]
    assert not any(sure for _, sure in L.detect(texts))
    assert L.detect([]) == []


def slow(text, model):
    """Sums by plain loops over the counts."""
    size = 1 + len(model.letters)
    out = []
    for counts in model.counts:
        three, two, one = {}, {}, {}
        for g, n in counts.items():
            three[g[:2]] = three.get(g[:2], 0) + n
            two[g[1:]] = two.get(g[1:], 0) + n
            one[g[2]] = one.get(g[2], 0) + n
        total = sum(one.values())
        s = 0
        for g in L.trigrams(text):
            p = (one.get(g[2], 0) + L.SMOOTHING) / (total + L.SMOOTHING * size)
            p = (two.get(g[1:], 0) + L.LEAN * p) / (sum(n for k, n in two.items() if k[0] == g[1]) + L.LEAN)
            p = (counts.get(g, 0) + L.LEAN * p) / (three.get(g[:2], 0) + L.LEAN)
            s += int(__import__("math").floor(100 * __import__("math").log(p) + 0.5))
        out.append(s)
    return out


def test_sums_are_those_of_plain_loops(monkeypatch):
    model = L.default()
    rng = random.Random(2)
    texts = [" ".join(rng.choice(sum(CAPTIONS.values(), [])) for _ in range(rng.randint(1, 6))) for _ in range(60)] + ["", "ça va, où ? Ünï", "x  y\n\nz!", "ж кот and dog"]
    want = []
    for t in texts:
        s = slow(t, model)
        best = max(range(len(s)), key=lambda i: (s[i], -i))
        want.append(model.languages[best])
    for window in (L.WINDOW, 50):  # a window ends at a space
        monkeypatch.setattr(L, "WINDOW", window)
        got = L.detect(texts)
        latin = [i for i, (language, _) in enumerate(got) if language in model.languages]
        assert len(latin) > 40 and all(got[i][0] == want[i] for i in latin)
    long = " ".join(CAPTIONS["de"]) + " "
    assert L.detect([long * 20_000, "the cat and the dog"]) == [("de", True), ("en", True)]


def test_as_a_column(spark):
    df = spark.createDataFrame([(1, "der Hund und die Katze"), (2, None), (3, "")], "i int, t string")
    got = {r["i"]: tuple(r["d"]) for r in df.select("i", L.native_language("t").alias("d")).collect()}
    assert got == {1: ("de", True), 2: ("", False), 3: ("", False)}
    assert df.limit(0).select(L.native_language("t").alias("d")).collect() == []
