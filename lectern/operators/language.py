"""Language of a title: stated, by script, by a decisive word, else by votes of marker words and letters; English if none.

A word given to several languages counts for none.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions import udfs as U

#: Words that are ordinary in a language and hardly stand in an English title.
MARKERS = {
    "German": """der die das dem den und im zur zum nach ueber über unter aus mit von vom bei zwischen ein eine einer eines
        deutsche deutschen deutscher japanische japanischen japanisches japanischer geschichte beitrag beitraege beiträge
        jahrhundert gegenwart entwicklung wesen leben welt sprache lehre bilder reise reisen briefe gesellschaft handel staat
        krieg kaiser sammlung verzeichnis herausgegeben uebersetzt übersetzt erzählungen erzaehlungen maerchen märchen
        wörterbuch worterbuch grammatik einführung einfuhrung darstellung untersuchungen kunst wirtschaft japans seine ihre
        bis nebst zwei drei vier unserer heutige heutigen""",
    "French": """le la les du des au aux et dans sur sous pour avec sans chez entre depuis japonais japonaise japonaises
        histoire histoires études etudes essai essais recueil mémoire mémoires memoires voyage voyages contes moeurs mœurs
        siècle siecle guerre paix pays peuple peuples traduit traduite traduction précédé precede dictionnaire grammaire
        religieuse religieuses ancien ancienne une cette leur notre lettres nouvelle nouvelles ouvrage etude étude illustrée
        illustre""",
    "Italian": """il lo gli dei delle della degli nel nella nelle con sul sulla giappone giapponese giapponesi storia viaggio
        viaggi relazione relazioni lettere arte nostra questa""",
    "Spanish": """el los las una unos unas por para del al japón japon japones japonés japonesa historia viaje viajes cartas
        relación relacion años ensayo edición edicion selección seleccion seguidos precedidos""",
    "Portuguese": """uma umas dos japão japao japoneza japonesa japoneses história viagem relação século seculo escreve cidade
        reino""",
    "Dutch": """het een van tot naar over japansche nederlandsche geschiedenis beschrijving reizen brieven verhandeling zijn
        uit onze""",
    "Latin": """liber libri librum rerum scriptores commentarii epistolae epistola japonica japonicae japoniae japonicum synodi
        decreta praelectiones linguae latinae alumnorum seminarii societatis jesu anni annis apud""",
    "Danish": "og til fra paa japansk japanske rejse skildringer",
    "Swedish": "och att från fran japansk japanska resa öfversikt ofversikt",
    "Norwegian": "og til fra paa japansk reise",
    "Russian": """iaponiia iaponii yaponiya yaponii zhenshchina sbornik rasskazy ocherki puteshestvie voina izdanie izd perevod
        russkaia russkii sovetskaia""",
}
#: A single one of these settles the language.
DECISIVE = {
    "German": """japanische japanischen japanisches japanischer geschichte jahrhundert wörterbuch worterbuch übersetzt uebersetzt
        märchen maerchen beiträge beitraege erzählungen erzaehlungen einführung einfuhrung gegenwart untersuchungen darstellung
        deutschen""",
    "French": """japonais japonaise japonaises études etudes mémoires memoires moeurs siècle siecle traduit traduite traduction
        dictionnaire précédé precede religieuse ouvrage""",
    "Italian": "giappone giapponese giapponesi viaggio viaggi relazioni",
    "Spanish": "japonés japones japonesa edición edicion selección seleccion años ensayo",
    "Portuguese": "japão japao japoneza japoneses história viagem relação século seculo",
    "Dutch": "japansche nederlandsche geschiedenis beschrijving verhandeling",
    "Latin": "japoniae japonica japonicae japonicum synodi praelectiones scriptores commentarii epistolae",
    "Russian": "iaponiia iaponii yaponiya zhenshchina putevoditel sbornik rasskazy ocherki puteshestvie",
    "Swedish": "öfversikt ofversikt japanska",
    "Danish": "japanske skildringer",
}
#: Letters of a language, and words that are no evidence.
LETTERS = {
    "German": "[äöüßÄÖÜ]",
    "French": "[àâçéèêëîïôùûœÀÂÇÉÈÊËÎÏÔÙÛŒ]",
    "Spanish": "[ñ¿¡]",
    "Portuguese": "[ãõÃÕ]",
    "Italian": "[àèéìòù]",
    "Danish": "[æøØÆ]",
    "Swedish": "[åÅ]",
    "Norwegian": "[æøØÆ]",
}
IGNORED = "a an the in of on to for and or at by no not with from as is it its his her their von van da de del della no ni ka wa ya ta sa ma ha na ne nu re ro ru shi chi tsu".split()
#: What sources call languages; '' where none is offered.
STATED = {
    "eng": "English", "ger": "German", "deu": "German", "fre": "French", "fra": "French", "jpn": "", "japanese": "", "ita": "Italian",
    "spa": "Spanish", "dut": "Dutch", "nld": "Dutch", "rus": "Russian", "lat": "Latin", "por": "Portuguese", "dan": "Danish",
    "swe": "Swedish", "nor": "Norwegian", "chi": "Chinese", "zho": "Chinese", "san": "Sanskrit", "kor": "Korean", "cze": "Czech",
    "pol": "Polish", "hun": "Hungarian", "mul": "", "und": "",
}


def unambiguous(pairs: Iterable[tuple[str, str]]) -> dict[str, list[str]]:
    """Words of each language that no other claims."""
    pairs = set(pairs)
    claims = Counter(w for _, w in pairs)
    out: dict[str, list[str]] = {}
    for language, word in sorted(pairs):
        if claims[word] == 1:
            out.setdefault(language, []).append(word)
    return out


def default_markers() -> list[tuple[str, str]]:
    return [(language, w) for language, words in MARKERS.items() for w in words.split()]


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once, however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _one_of(own: list[str]) -> Callable[[Column], Column]:
    return lambda w: w.isin(own)


def _vote(language: str, letters: Column, words: Column) -> Callable[[Column], Column]:
    """The language's vote by the markers found, null without any sign."""

    def of(found: Column) -> Column:
        n = F.size(F.array_distinct(found))
        score = n + F.when(letters, 1.5).otherwise(0.0) + F.when((n > 0) & (F.size(found) / F.size(words) >= 0.3), 0.5).otherwise(0.0)
        return F.when((n > 0) | letters, F.struct((-score).alias("minus"), F.lit(language).alias("language"), n.alias("n")))

    return of


def words_of(title: Column) -> Column:
    """A title's words as markers have them: in small letters, composed, without those to be ignored."""
    # only titles with a mark of its own are taken out of the JVM
    decomposed = U.compose(F.when(title.rlike(r"\p{M}"), title))
    title = F.coalesce(decomposed, title)
    every = F.regexp_extract_all(F.lower(title), F.lit(r"([\p{L}\p{M}]+)"), F.lit(1))
    return F.filter(every, lambda w: ~w.isin(IGNORED))


def votes(title: Column, words: Column, markers: Iterable[tuple[str, str]] | None = None) -> Column:
    """array<struct(score, language, n)>, languages with any sign, the best first; equal scores by name.

    A language scores its distinct marker words, 1.5 for its letters and 0.5 where three tenths of the words are markers. The
    words are looked up in all markers at once; each language then sees the few that are any's."""
    table = unambiguous(default_markers() if markers is None else markers)
    known = sorted({w for own in table.values() for w in own})

    def ranked(hits: Column) -> Column:
        made = []
        for language in sorted({*table, *LETTERS}):
            letters = title.rlike(LETTERS[language]) if language in LETTERS else F.lit(False)
            made.append(_bound(F.filter(hits, _one_of(table.get(language, ["-"]))), _vote(language, letters, words)))
        return F.transform(F.array_sort(F.array_compact(F.array(*made))), lambda s: F.struct((-s["minus"]).alias("score"), s["language"].alias("language"), s["n"].alias("n")))

    return _bound(F.filter(words, lambda w: w.isin(known)) if known else F.array().cast("array<string>"), ranked)


def guess(title: Column, other: Column, markers: Iterable[tuple[str, str]] | None = None) -> Column:
    """struct(language, confidence)."""
    answer = lambda language, confidence: F.struct((F.lit(language) if isinstance(language, str) else language).alias("language"), (F.lit(confidence) if isinstance(confidence, float) else confidence).alias("confidence"))
    stated = F.regexp_extract(F.coalesce(other, F.lit("")), r"Language: ([A-Za-z]+)", 1)
    codes = F.create_map(*(F.lit(x) for pair in STATED.items() for x in pair))
    named = F.when(stated != "", F.coalesce(codes[F.lower(stated)], F.initcap(stated))).otherwise("")
    telling = sorted({w for own in DECISIVE.values() for w in own.split()})

    def voted(ranked: Column) -> Column:
        best, second = F.get(ranked, F.lit(0)), F.coalesce(F.get(ranked, F.lit(1))["score"], F.lit(0.0))
        sure = F.round(F.least(F.lit(0.95), 0.6 + (best["score"] - second) / 4 + 0.05 * F.least(best["n"], F.lit(4))), 2)
        return F.when(F.size(ranked) == 0, answer("English", 0.85)).when(best["score"] < 2, answer("English", 0.5)).otherwise(answer(best["language"], sure))

    def judged(words: Column) -> Column:
        settled = lambda hits: F.array_compact(F.array(*(F.when(F.exists(hits, _one_of(own.split())), F.lit(language)) for language, own in DECISIVE.items())))
        decided = _bound(F.filter(words, lambda w: w.isin(telling)), settled)
        return _bound(decided, lambda d: F.when(F.size(words) == 0, answer("English", 0.3)).when(F.size(d) == 1, answer(F.get(d, F.lit(0)), 0.85)).otherwise(_bound(votes(title, words, markers), voted)))

    return (
        F.when(named != "", answer(named, 1.0))
        .when(title.rlike("[぀-ヿ一-鿿]"), answer("", 0.9))
        .when(title.rlike("[Ѐ-ӿ]"), answer("Russian", 0.95))
        .otherwise(_bound(words_of(title), judged))
    )


def language_of(key: Column, fixes: Column, title: Column, other: Column) -> Column:
    """The language checked by hand, unless that is blank, else guessed. fixes: map from entity key to language."""
    return F.coalesce(F.nullif(fixes[key], F.lit("")), guess(title, other)["language"])
