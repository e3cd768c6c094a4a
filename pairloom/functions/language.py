"""the language of a text, by letter trigrams and scripts, with a margin as reliability.

``Model`` counts the trigrams of words (with a space before and behind) in a seed text of
each language, and weighs each with a smoothed log-probability, as a whole number.  A text's
language is the one with the greatest sum; it is reliable where the second is ``MARGIN``
behind and a third of the text's trigrams are among the language's own.  A script that has
a third of the letters, and one language here, tells the language by itself.

Texts are read once: an Arrow batch becomes one array of letters, and sums are taken by
array operations over windows of ``WINDOW`` letters, whatever the texts' lengths.
"""

from __future__ import annotations

from collections import Counter
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Seed texts: everyday words and captions, written for this purpose.
SEEDS = {
    "de": """der die das und ist nicht mit den von ein eine für auf im dem sich auch werden aus bei nach wie noch nur oder aber vor zur bis mehr durch man sein wurde sind wird
        Der Hund läuft über die Straße und die Katze schläft auf dem Sofa. Ein schönes Haus mit Garten am Wasser, im Hintergrund die Berge. Rote Schuhe aus Leder für Damen und Herren, günstig online kaufen.
        Das Mädchen trägt ein weißes Kleid und eine schwarze Tasche. Wir wünschen euch einen guten Morgen und viel Glück zum Geburtstag. Die Kinder spielen zusammen im Schnee. Neue Möbel für Küche, Bad und Wohnzimmer.
        Die schnelle Lieferung kommt zurück nach Hause. Zwei junge Männer fahren mit dem Fahrrad durch die alte Stadt. Möglichkeiten, Gesellschaft, Freiheit, Zeitung, Beispiel, Geschichte, Bilder, Arbeit, sprechen, zwischen, gegen, Jahre
        blau grün gelb braun grau rosa alt klein groß lang kurz hoch breit neu gut schlecht warm kalt hell dunkel bunt Sommer Winter Frühling Herbst Hose Jacke Mantel Rock Bluse Stiefel Handschuhe Mütze Uhr Schmuck Kette
        Tisch Stuhl Schrank Bett Lampe Teppich Fenster Tür Wand Boden Decke Baum Blume Wald Wiese Fluss See Meer Strand Himmel Wolken Sonne Mond Sterne Auto Bus Zug Flugzeug Schiff Brücke Kirche Schloss Markt Bahnhof
        Mann Frau Kind Mutter Vater Schwester Bruder Freund Hochzeit Urlaub Reise Küche Kuchen Brot Käse Fleisch Gemüse Apfel Kaffee Bier Wein Rezept einfach lecker Zeichnung Gemälde Aufkleber Karte Buch Seite Preis Größe""",
    "en": """the and of to is that with for was this are from have not you it on by at be or as an they which one all would there what their out about if when who will more into
        The dog runs across the street and the cat sleeps on the sofa. A beautiful house with a garden near the water, mountains in the background. Red leather shoes for men and women, buy cheap online.
        The girl is wearing a white dress and a black bag. We wish you a good morning and a happy birthday. The children are playing together in the snow. New furniture for kitchen, bathroom and living room.
        Fast shipping right back to your home. Two young people ride their bikes through the old town. Something, everything, nation, question, government, through, thought, should, between, pictures, working, enough, light, years, world, free photo of
        blue green yellow brown grey pink old small large long short high wide new bad warm cold bright dark vintage summer winter spring autumn jeans trousers jacket coat skirt shirt boots gloves hat watch jewelry necklace
        wooden table chair cupboard bed lamp carpet window door wall floor ceiling tree flower forest meadow river lake sea beach sky clouds sun sunset moon stars ocean car bus train plane ship bridge church castle market station brass handle polished
        man woman child mother father sister brother friend wedding holiday travel kitchen cake bread cheese meat vegetables apple coffee beer wine recipe easy delicious drawing painting sticker card book page price size with logo design set of two""",
    "es": """el los las que una por con para del está como más pero sus se y es de la en un no su al lo le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue había
        El perro corre por la calle y el gato duerme en el sofá. Una hermosa casa con jardín cerca del agua, montañas al fondo. Zapatos rojos de cuero para hombre y mujer, comprar barato en línea.
        La niña lleva un vestido blanco y un bolso negro. Le deseamos buenos días y un feliz cumpleaños. Los niños juegan juntos en la nieve. Muebles nuevos para cocina, baño y sala.
        Envío rápido de vuelta a tu casa. Dos jóvenes van en bicicleta por el casco antiguo de la ciudad. Nación, corazón, años, señor, mañana, ellos, lleno, desarrollo, gobierno, mientras, siempre, imágenes, trabajo, tiempo, mundo, fotos de
        azul verde amarillo marrón gris rosa viejo pequeño grande largo corto alto ancho nuevo malo cálido frío claro oscuro antiguo verano invierno primavera otoño pantalones vaqueros chaqueta abrigo falda camisa botas guantes sombrero reloj joyas collar zapatillas correr
        mesa silla armario cama lámpara alfombra ventana puerta pared suelo techo árbol flor bosque prado río lago mar playa cielo nubes sol luna estrellas coche autobús tren avión barco puente iglesia castillo mercado estación
        hombre mujer niño madre padre hermana hermano amigo boda vacaciones viaje cocina pastel pan queso carne verduras manzana café cerveza vino receta fácil delicioso dibujo pintura pegatina tarjeta libro página precio tamaño elegante""",
    "fr": """le les des une est que dans pour qui sur pas avec plus du et il au ce de la un en ne se son par je vous sont aux nous mais ou leur cette elle tout bien être fait même ces
        Le chien court dans la rue et le chat dort sur le canapé. Une belle maison avec un jardin près de l'eau, des montagnes à l'arrière-plan. Chaussures rouges en cuir pour homme et femme, acheter pas cher en ligne.
        La fille porte une robe blanche et un sac noir. Nous vous souhaitons une bonne journée et un joyeux anniversaire. Les enfants jouent ensemble dans la neige. Nouveaux meubles pour la cuisine, la salle de bains et le salon.
        Livraison rapide jusqu'à votre maison. Deux jeunes gens roulent à vélo dans la vieille ville. Question, développement, château, beauté, lumière, français, garçon, toujours, œuvre, images, travail, année, monde, photos gratuites
        bleu vert jaune brun gris rose vieux petit grand long court haut large nouveau mauvais chaud froid clair foncé ancien été hiver printemps automne pantalon jean veste manteau jupe chemise bottes gants chapeau montre bijoux collier chaussures course
        table chaise armoire lit lampe tapis fenêtre porte mur sol plafond arbre fleur forêt pré rivière lac mer plage ciel nuages soleil lune étoiles voiture autobus train avion bateau pont église château marché gare
        homme femme enfant mère père sœur frère ami mariage vacances voyage cuisine gâteau pain fromage viande légumes pomme café bière vin recette facile délicieux dessin peinture autocollant carte livre page prix taille vendre élégant""",
    "it": """il che di una per con non sono della gli nel anche è alla dei più ed si la lo un in da le del al come ma se dal nella suo questo delle ha cui essere stato quando molto tra
        Il cane corre per la strada e il gatto dorme sul divano. Una bella casa con giardino vicino all'acqua, montagne sullo sfondo. Scarpe rosse di pelle per uomo e donna, acquistare a buon prezzo.
        La ragazza indossa un vestito bianco e una borsa nera. Vi auguriamo una buona giornata e un felice compleanno. I bambini giocano insieme nella neve. Nuovi mobili per la cucina, il bagno e il soggiorno.
        Spedizione veloce fino a casa tua. Due giovani vanno in bicicletta per la città vecchia. Questione, sviluppo, perché, città, famiglia, figlio, ogni, soltanto, immagini, lavoro, tempo, mondo, bellezza, ancora, prezzo, azzurro, zucchero
        blu verde giallo marrone grigio rosa vecchio piccolo grande lungo corto alto largo nuovo cattivo caldo freddo chiaro scuro antico estate inverno primavera autunno pantaloni giacca cappotto gonna camicia stivali guanti cappello orologio gioielli collana vestito rosso elegante
        tavolo sedia armadio letto lampada tappeto finestra porta parete pavimento soffitto albero fiore bosco prato fiume lago mare spiaggia cielo nuvole sole luna stelle macchina autobus treno aereo nave ponte chiesa castello mercato stazione
        uomo donna bambino madre padre sorella fratello amico matrimonio vacanza viaggio cucina torta pane formaggio carne verdure mela caffè birra vino ricetta facile delizioso disegno dipinto adesivo carta libro pagina prezzo misura scarpe""",
    "nl": """het een van en niet dat met voor zijn op aan te naar bij ook maar er ik de in is was om als dan hij heeft die nog door worden over ze uit kan tot hebben deze wel geen
        De hond loopt over de straat en de kat slaapt op de bank. Een mooi huis met tuin aan het water, bergen op de achtergrond. Rode leren schoenen voor heren en dames, goedkoop online kopen.
        Het meisje draagt een witte jurk en een zwarte tas. Wij wensen jullie een goede morgen en een fijne verjaardag. De kinderen spelen samen in de sneeuw. Nieuwe meubels voor keuken, badkamer en woonkamer.
        Snelle levering terug naar huis. Twee jonge mensen fietsen door de oude stad. Vrijheid, gezelschap, zee, boeken, geschiedenis, mogelijk, altijd, tussen, jaar, foto's, werk, wereld, vrouw, uur, kleine, groot, gewoon, blijven
        blauw groen geel bruin grijs roze oud klein groot lang kort hoog breed nieuw slecht warm koud licht donker zomer winter lente herfst broek jas mantel rok overhemd laarzen handschoenen muts horloge sieraden ketting
        tafel stoel kast bed lamp tapijt raam deur muur vloer plafond boom bloem bos weide rivier meer strand hemel wolken zon maan sterren auto bus trein vliegtuig schip brug kerk kasteel markt station
        man vrouw kind moeder vader zus broer vriend bruiloft vakantie reis keuken taart brood kaas vlees groenten appel koffie bier wijn recept makkelijk lekker tekening schilderij sticker kaart boek pagina prijs maat fietsen schoenen huisje""",
    "pt": """o os uma que não com para dos das em por mais como foi ao são se e a do da no na um as seu sua ou ser quando muito há nos já está eu também só pelo pela até isso ela
        O cão corre pela rua e o gato dorme no sofá. Uma bela casa com jardim perto da água, montanhas ao fundo. Sapatos vermelhos de couro para homem e mulher, comprar barato online.
        A menina usa um vestido branco e uma bolsa preta. Desejamos um bom dia e um feliz aniversário. As crianças brincam juntas na neve. Móveis novos para cozinha, banheiro e sala.
        Entrega rápida de volta à sua casa. Dois jovens andam de bicicleta pela cidade velha. Nação, coração, questão, informações, então, mãe, filho, trabalho, olhos, também, mundo, imagens, tempo, ainda, você, fotos, lindo, cabelo, melhor
        azul verde amarelo marrom cinza rosa velho pequeno grande longo curto alto largo novo ruim quente frio claro escuro antigo verão inverno primavera outono calça jaqueta casaco saia camisa botas luvas chapéu relógio joias colar manga curta
        mesa cadeira armário cama lâmpada tapete janela porta parede chão teto árvore flor floresta campo rio lago mar praia céu nuvens sol lua estrelas carro ônibus trem avião navio ponte igreja castelo mercado estação
        homem mulher criança mãe pai irmã irmão amigo casamento férias viagem cozinha bolo pão queijo carne legumes maçã café cerveja vinho receita fácil delicioso desenho pintura adesivo cartão livro página preço tamanho promoção edição""",
}

#: Code points (first, last) of the scripts that have one language here.
SCRIPTS = {
    "ar": ((0x600, 0x6FF), (0x750, 0x77F), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "el": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "he": ((0x590, 0x5FF),),
    "hi": ((0x900, 0x97F),),
    "ja": ((0x3040, 0x30FF),),
    "ko": ((0x1100, 0x11FF), (0xAC00, 0xD7AF)),
    "ru": ((0x400, 0x52F),),
    "th": ((0xE00, 0xE7F),),
    "zh": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2A6DF)),
}

#: A hundredth of a natural logarithm is the unit: the best must be this far ahead.
MARGIN = 200
LEAST_TRIGRAMS = 6
#: One in so many of a reliable text's trigrams must be in the language's seed.
OWN = 3
SMOOTHING = 0.5
LEAN = 4
WINDOW = 1 << 20
#: Of script: no letter, and a letter of no script above.
_NONE, _LATIN = 255, 254


def trigrams(text: str) -> list[str]:
    """The trigrams of a text's words: lower-cased letters, a space before and behind each word."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    return [f" {w} "[i : i + 3] for w in words for i in range(len(w))]


class Model:
    """Weights of trigrams by language, from a seed text each: a hundred times the logarithm of the
    third letter's probability behind the first two, which leans on that behind the second, and that on
    the letter's own, the less the more often the first letters were seen (``LEAN``)."""

    def __init__(self, seeds: dict[str, str]):
        self.languages = sorted(seeds)
        self.counts = [Counter(trigrams(seeds[k])) for k in self.languages]
        self.letters = sorted({c for counts in self.counts for g in counts for c in g})  # the space is the first

    @property
    def tables(self) -> tuple[np.ndarray, np.ndarray, int]:
        """The number of each letter (0: none, 1: of no seed); by trigram number the weights times
        2^32, plus one where the seed has it, so that one sum has both; the count of numbers."""
        number = np.zeros(0x110000, np.uint8)
        number[np.frombuffer("".join(c for c in map(chr, [*range(0xD800), *range(0xE000, 0x110000)]) if c.isalpha()).encode("utf-32-le"), "<u4")] = 1
        known = self.letters[1:]
        number[[ord(c) for c in known]] = np.arange(2, 2 + len(known))
        size = 2 + len(known)
        weights = []
        for counts in self.counts:
            three = np.zeros((size,) * 3)
            for g, n in counts.items():
                three[tuple(number[[ord(c) for c in g]])] = n
            two = three.sum(0)
            one = two.sum(0)
            p = (one + SMOOTHING) / (one.sum() + SMOOTHING * size)
            p = (two + LEAN * p) / (two.sum(1, keepdims=True) + LEAN)
            p = (three + LEAN * p) / (three.sum(2, keepdims=True) + LEAN)
            weights.append((np.floor(100 * np.log(p) + 0.5).astype(np.int64) * (1 << 32) + (three > 0)).ravel())
        return number, np.stack(weights), size


@cache
def default() -> Model:
    return Model(SEEDS)


_tables: dict[int, tuple] = {}


def _script_of() -> np.ndarray:
    out = np.full(0x110000, _LATIN, np.uint8)
    for i, ranges in enumerate(SCRIPTS.values()):
        for a, b in ranges:
            out[a : b + 1] = i
    return out


_scripts = cache(_script_of)


def detect(texts: list[str | None], model: Model | None = None) -> list[tuple[str, bool]]:
    """(language, whether it is reliable) of each text; ('', False) for null, and for texts without letters."""
    model = model or default()
    if id(model) not in _tables:
        _tables[id(model)] = (*model.tables, model)
    number, table, size, _ = _tables[id(model)]
    n, k = len(texts), len(model.languages)
    totals, letters = np.zeros((k, n), np.int64), np.zeros((len(SCRIPTS) + 1, n), np.int64)
    lot: list[str] = []
    places: list[int] = []

    def flush() -> None:
        joined = " ".join(lot)
        codes = np.frombuffer(f" {joined} ".encode("utf-32-le", "replace"), "<u4")
        sizes = np.array([len(t) + 1 for t in lot])
        sizes[0] += 1
        here = np.repeat(np.array(places, np.int32), sizes)
        kinds = number[codes]
        real = kinds > 0
        script = _scripts()[codes[real]]
        of = here[real]
        other = script != _LATIN
        letters[-1] += np.bincount(of[~other], minlength=n)
        if other.any():
            letters[:-1] += np.bincount(script[other].astype(np.int64) * n + of[other], minlength=len(SCRIPTS) * n).reshape(-1, n)
        keep = real | np.append(True, real[:-1])  # of several characters between words, one
        kinds, here = kinds[keep].astype(np.int32), here[keep]
        code = (kinds[:-2] * size + kinds[1:-1]) * size + kinds[2:]
        good = kinds[1:-1] > 0
        code, mid = code[good], here[1:-1][good]
        if len(code):
            starts = np.flatnonzero(np.append(True, mid[1:] != mid[:-1]))
            for i in range(k):
                np.add.at(totals[i], mid[starts], np.add.reduceat(table[i][code], starts))

    held = 0
    for i, t in enumerate(texts):
        low = (t or "").lower()
        a = 0
        while a < len(low):
            # A long text goes by windows that end at a space; only a longer run of letters is cut.
            end = a + WINDOW if a + WINDOW < len(low) else len(low)
            if end < len(low):
                end = low.rfind(" ", a, end) + 1 or end
            if held + end - a > WINDOW and lot:
                flush()
                lot, places, held = [], [], 0
            lot.append(low[a:end])
            places.append(i)
            held += end - a
            a = end
    if lot:
        flush()

    sums, own, all_letters = totals >> 32, totals & 0xFFFFFFFF, letters.sum(0)
    order = np.argsort(-sums, axis=0, kind="stable")
    best = order[0]
    rows = np.arange(n)
    ahead = sums[best, rows] - (sums[order[1], rows] if k > 1 else 0)
    count = letters[-1]  # a trigram for each letter; those of other scripts are unseen everywhere
    sure = (ahead >= MARGIN) & (all_letters >= LEAST_TRIGRAMS) & (OWN * own[best, rows] >= all_letters)
    out = []
    for i in range(n):
        script = next((s for j, s in enumerate(SCRIPTS) if all_letters[i] and 3 * letters[j, i] >= all_letters[i]), None)
        if script:
            out.append((script, True))
        else:
            out.append((model.languages[best[i]] if count[i] and own[best[i], i] else "", bool(sure[i])))
    return out


def native_language(c: str | Column, model: Model | None = None) -> Column:
    """F3 without an injected detector: struct of language and reliable."""

    @F.pandas_udf("language string, reliable boolean")
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(detect(s.tolist(), model), columns=["language", "reliable"])

    return run(F.col(c) if isinstance(c, str) else c)
