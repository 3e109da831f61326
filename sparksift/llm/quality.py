"""Operator 6: quality rules, line first. SQL functions only.

Each line with a word is held against three kinds of rule: punctuation (runs of symbols or exclamation marks,
fragments without an end mark), navigation (menus with separators, rows of links) and boilerplate (legal and site
notices in English, German, French and Spanish, whatever the document's language).
Lines that fail are taken out, and a document that loses more than a share of its word characters is rejected.
Beside that stands the base verdict over the whole text: too few words, or too many of them in repeated windows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import OWN, need, staged, table

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
SEPARATOR = r"[|»›·•]"
ENDING = r"""[.!?:;,)"'…»”’\]][\x20\x09-\x0D]*$"""
LINK = r"https?://|www[.]"
#: By language the notices of sites. Letters beyond ASCII stand in both cases, since (?i) folds ASCII only.
PHRASES = {
    "en": (
        r"all rights reserved|cookie (policy|settings|notice)|privacy policy|terms of (use|service)|"
        r"(enable|requires) javascript|click here|sign up|log ?in to|subscribe (now|to)|skip to (main )?content|"
        r"share (this )?on (facebook|twitter)|follow us|powered by|back to top"
    ),
    "de": (
        r"alle rechte vorbehalten|cookie-(richtlinie|einstellungen|hinweis)|datenschutz(erkl[äÄ]rung|hinweise|bestimmungen)|"
        r"allgemeine gesch[äÄ]ftsbedingungen|nutzungsbedingungen|javascript aktivieren|hier klicken|klicken sie hier|jetzt (anmelden|registrieren|abonnieren)|"
        r"newsletter abonnieren|zum (haupt)?inhalt springen|auf (facebook|twitter) teilen|folgen sie uns|zur[üÜ]ck nach oben"
    ),
    "fr": (
        r"tous droits r[éÉ]serv[éÉ]s|(politique|gestion|param[èÈ]tres) (de|des) cookies|politique de confidentialit[éÉ]|"
        r"conditions (g[éÉ]n[éÉ]rales )?d['’]utilisation|mentions l[éÉ]gales|activer javascript|cliquez ici|(abonnez|inscrivez)-vous|"
        r"aller au contenu|partager sur (facebook|twitter)|suivez-nous|retour en haut"
    ),
    "es": (
        r"todos los derechos reservados|pol[íÍ]tica de (cookies|privacidad)|(configuraci[óÓ]n|aviso) de cookies|"
        r"t[éÉ]rminos (y condiciones|de (uso|servicio))|aviso legal|(active|activar|habilite|habilitar) javascript|(haga|haz) clic aqu[íÍ]|"
        r"suscr[íÍ]bete (ahora|a)|saltar al contenido|compartir en (facebook|twitter)|s[íÍ]guenos en|volver arriba"
    ),
}
BOILERPLATE = "(?i)" + "|".join(PHRASES.values())
#: A lower-cased line without any of these holds no BOILERPLATE; plain searches are far cheaper than its pattern.
NEEDED = (
    " rights reserved", "cookie ", "privacy policy", "terms of ", " javascript", "click here", "sign up", "in to", "subscribe ", "skip to ",
    "share ", "follow us", "powered by", "back to top",
    "rechte vorbehalten", "cookie-", "datenschutz", "sbedingungen", "javascript aktiv", "hier klicken", "klicken sie hier", "jetzt a", "jetzt registrieren",
    "newsletter abonnieren", "inhalt springen", " teilen", "folgen sie uns", "ck nach oben",
    "tous droits r", " cookies", " de confidentialit", "utilisation", "mentions l", "cliquez ici", "ez-vous", "aller au contenu", "partager sur ",
    "suivez-nous", "retour en haut",
    "derechos reservados", "tica de privacidad", "rminos ", "aviso legal", " clic aqu", "bete a", "saltar al contenido", "compartir en ", "guenos en", "volver arriba",
)
MARKS = r"[#*$%&|<>»›·•]|!!|://|www[.]"
WINDOW = 5


@dataclass(frozen=True)
class Rules:
    """Parameters. Counts of a line are held against its words."""

    min_words: int = 10
    max_repeat_percent: int = 20
    symbols_per_word: float = 0.5
    bangs_per_word: float = 0.25
    separators_per_word: float = 0.25
    links_per_word: float = 0.5
    least_marks: int = 3
    stub_words: int = 3
    max_lost: float = 0.5


def any_of(text: Column, parts: tuple[str, ...]) -> Column:
    """Whether text, lower-cased once, holds one of parts."""
    return F.exists(F.array(F.lower(text)), lambda x: reduce(or_, (x.contains(part) for part in parts)))


def line_fails(line: Column, n: Column, rules: Rules) -> Column:
    """Whether a line of n > 0 words fails a rule."""
    symbols = F.regexp_count(line, F.lit(SYMBOL))
    bangs = F.regexp_count(line, F.lit("!!"))
    separators = F.regexp_count(line, F.lit(SEPARATOR))
    links = F.regexp_count(line, F.lit(LINK))
    marks = (
        ((symbols >= rules.least_marks) & (symbols > rules.symbols_per_word * n))
        | ((bangs >= rules.least_marks) & (bangs > rules.bangs_per_word * n))
        | ((separators >= rules.least_marks) & (separators > rules.separators_per_word * n))
        | ((links >= rules.least_marks) & (links > rules.links_per_word * n))
    )
    return (line.rlike(MARKS) & marks) | ((n <= rules.stub_words) & ~line.rlike(ENDING)) | ((n <= 30) & any_of(line, NEEDED) & line.rlike(BOILERPLATE))


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long")


def measured(docs: DataFrame, text_col: str, rules: Rules = Rules()) -> DataFrame:
    """docs with the measures in columns of OWN prefix. One row is worked on at a time; nothing is shuffled."""
    o = lambda name: f"{OWN}{name}"
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.withColumn(o("text"), text)
    df = df.withColumns({o("words"): F.regexp_extract_all(F.col(o("text")), F.lit(WORD), 0), o("parsed"): F.transform(F.split(o("text"), "\n", -1), lambda x: F.struct(x.alias("line"), F.regexp_count(x, F.lit(WORD)).alias("n")))})
    df = df.withColumn(o("lines"), F.filter(o("parsed"), lambda x: x["n"] > 0)["line"])
    df = df.withColumns({
        o("n_words"): F.size(o("words")).cast("long"),
        # 64-bit hashes stand for words and windows; two windows of one text that differ share one with a chance of about n^2 / 2^65.
        o("hashes"): F.transform(o("words"), lambda x: F.xxhash64(x)),
        o("word_chars"): F.length(F.array_join(o("words"), "")).cast("long"),
        o("n_symbols"): F.regexp_count(F.col(o("text")), F.lit(SYMBOL)).cast("long"),
        o("n_dup_lines"): (F.size(o("lines")) - F.size(F.array_distinct(o("lines")))).cast("long"),
        o("kept_lines"): F.filter(o("parsed"), lambda x: (x["n"] == 0) | ~line_fails(x["line"], x["n"], rules))["line"],
    })
    h = F.col(o("hashes"))
    at = lambda i, k: F.get(h, i + k)
    windows = F.transform(F.sequence(F.lit(0), F.col(o("n_words")).cast("int") - WINDOW), lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)]))
    df = df.withColumn(o("windows"), F.when(F.col(o("n_words")) >= WINDOW, windows).otherwise(F.array().cast("array<long>")))
    # Only texts with a repeated window pay for finding where its places are.
    some = F.size(F.array_distinct(o("windows"))) < F.size(o("windows"))
    ranked = F.sort_array(F.transform(o("windows"), lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    df = df.withColumn(o("ranked"), F.when(some, ranked))
    r = F.col(o("ranked"))
    same = lambda x, j: F.coalesce(F.get(r, j)["h"] == x["h"], F.lit(False))
    places = F.filter(r, lambda x, j: same(x, j - 1) | same(x, j + 1))
    df = df.withColumn(o("places"), F.sort_array(F.transform(places, lambda x: x["i"])))
    p = F.col(o("places"))
    covered = F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    df = df.withColumns({o("n_repeat_words"): F.coalesce(covered, F.lit(0)).cast("long"), o("clean"): F.array_join(o("kept_lines"), "\n")})
    base = (F.col(o("n_words")) < rules.min_words) | (100 * F.col(o("n_repeat_words")) > rules.max_repeat_percent * F.col(o("n_words")))
    whole = F.size(o("kept_lines")) == F.size(o("parsed"))
    left = F.when(whole, F.col(o("word_chars"))).otherwise(word_chars(F.col(o("clean"))))
    df = df.withColumn(o("base_failed"), base)
    return df.withColumn(o("kept"), ~F.col(o("base_failed")) & (left >= (1 - rules.max_lost) * F.col(o("word_chars"))))


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """Per row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed, kept (boolean), clean (text without failed lines).

    A null text has no words: all counts 0, base_failed true, kept false. Repeated rows and null ids are carried; other
    columns are left out, so their names can't clash. An empty table gives an empty one.
    """
    need(docs, [id_col, text_col])
    out = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean"]
    df = measured(docs.select(F.col(id_col), F.col(text_col)), text_col, rules)
    return df.select(F.col(id_col), *[F.col(f"{OWN}{c}").alias(c) for c in out])


def clean_documents(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", rules: Rules = Rules()) -> DataFrame:
    """The kept rows of docs, all columns, with failed lines taken out of the text; chars_col gets its new length.

    Null and empty texts have no words and go; repeated rows stay or go alike; an empty table gives an empty one."""
    need(docs, [text_col])
    columns = docs.columns
    # Written before it is filtered: a filter would be written out in all the expressions that its columns rest on, which
    # multiply at each step.
    df = measured(docs, text_col, rules).withColumn(text_col, F.col(f"{OWN}clean"))
    df = staged(df.select(*columns, f"{OWN}kept"), "quality").filter(F.col(f"{OWN}kept"))
    if chars_col and chars_col in columns:
        df = df.withColumn(chars_col, F.length(text_col).cast("long"))
    return df.select(*columns)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents; null counts as no words, repeated rows each give a row, an empty table gives an empty one."""
    # Written, so that what is built on top of it meets columns and not their expressions.
    return staged(quality_report(table(spark, sf_dir, "documents")).drop("clean"), "report")


_TERMS = BOILERPLATE.replace("'", "''")
_END = ENDING.replace("'", "''")
OP6_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{WORD}') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l FROM d),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 4), ' ') AS g FROM w, unnest(generate_series(1, len(w) - 4)) AS u(i)),
dup AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM dup, (VALUES (0), (1), (2), (3), (4)) AS o(k) WHERE c > 1 GROUP BY doc_id),
li AS (SELECT doc_id, x, len(regexp_extract_all(x, '{WORD}')) AS n, len(regexp_extract_all(x, '{SYMBOL}')) AS s,
         len(regexp_extract_all(x, '!!')) AS b, len(regexp_extract_all(x, '{SEPARATOR}')) AS p,
         len(regexp_extract_all(x, '{LINK}')) AS k FROM w, unnest(l) AS u(x)),
good AS (SELECT doc_id, sum(length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g'))) AS c FROM li
         WHERE NOT ((s >= 3 AND s > 0.5 * n) OR (b >= 3 AND b > 0.25 * n) OR (p >= 3 AND p > 0.25 * n) OR (k >= 3 AND k > 0.5 * n)
                 OR (n <= 3 AND NOT regexp_matches(x, '{_END}')) OR (n <= 30 AND regexp_matches(x, '{_TERMS}'))) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        len(regexp_extract_all(t, '{SYMBOL}'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
        coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(good.c, 0)::BIGINT AS good
      FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id LEFT JOIN good ON good.doc_id = w.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       (NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND good >= 0.5 * word_chars) AS kept
FROM m
"""
