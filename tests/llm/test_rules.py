"""Quality rules, licences, url filter, decontamination on small frames."""

import random
import re
from itertools import combinations

from pyspark.sql import functions as F

from sparksift.llm import decontaminate as dc
from sparksift.llm import licence_texts, licences, quality, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeats(text):
    w = WORD.findall(text)
    seen = {}
    for k in range(len(w) - 4):
        seen.setdefault(tuple(w[k : k + 5]), []).append(k)
    return len({k + j for at in seen.values() if len(at) > 1 for k in at for j in range(5)})


def test_quality_edges(spark, documents, edge_rows):
    loop = "a b c d e f " * 6
    rows = [*edge_rows, (20, loop), (21, "x x x x x x x x x x x x"), (22, "A line of plain words that ends well, and says so.\nHome | About | Contact | Help | More\nThen comes something else altogether, with other things to tell."), (23, "Home | About | Contact | Help | Jobs | News | Map | Terms | Imprint | Blog")]
    got = {(r["doc_id"], r["n_words"]): r for r in quality.quality_report(documents(rows)).collect()}
    for i, t in rows:
        t = t or ""
        w = WORD.findall(t)
        r = got[i, len(w)]
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert r["word_chars"] == sum(map(len, w)) and r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", t))
        assert r["n_dup_lines"] == len(lines) - len(set(lines)) and r["n_repeat_words"] == repeats(t)
        assert r["base_failed"] == (len(w) < 10 or 100 * repeats(t) > 20 * len(w)) and not (r["base_failed"] and r["kept"])
    by = {i: r for (i, _), r in got.items()}
    assert by[22]["kept"] and "Home" not in by[22]["clean"] and not by[23]["kept"]
    assert quality.quality_report(documents(rows).limit(0)).count() == 0
    kept = quality.clean_documents(documents(rows).withColumn("n_chars", F.lit(0)))
    assert kept.columns[:2] == ["doc_id", "text"] and {r["doc_id"] for r in kept.collect()} == {i for (i, _), r in got.items() if r["kept"]}
    assert kept.filter("n_chars <> length(text)").count() == 0


def test_quality_gates_lose_no_line(spark):
    """The cheap searches before the patterns let every line through that a pattern finds."""
    notices = ["All rights reserved", "COOKIE settings", "cookie policy", "cookie notice", "Privacy Policy", "terms of use", "TERMS of Service", "enable JavaScript", "requires javascript", "click here", "Sign Up", "log in to", "LOGIN to",
               "subscribe now", "Subscribe to", "skip to content", "skip to main content", "share on Facebook", "share this on twitter", "follow us", "Powered By", "back to TOP",
               "Alle Rechte vorbehalten", "Cookie-Richtlinie", "cookie-einstellungen", "COOKIE-HINWEIS", "Datenschutzerklärung", "DATENSCHUTZERKLÄRUNG", "Datenschutzhinweise", "datenschutzbestimmungen",
               "Allgemeine Geschäftsbedingungen", "ALLGEMEINE GESCHÄFTSBEDINGUNGEN", "Nutzungsbedingungen", "Bitte JavaScript aktivieren", "hier klicken", "Klicken Sie hier", "Jetzt anmelden", "jetzt registrieren", "jetzt abonnieren",
               "Newsletter abonnieren", "zum Inhalt springen", "Zum Hauptinhalt springen", "auf Facebook teilen", "auf Twitter teilen", "Folgen Sie uns", "zurück nach oben", "ZURÜCK nach oben",
               "Tous droits réservés", "TOUS DROITS RÉSERVÉS", "politique de cookies", "gestion des cookies", "Paramètres des cookies", "Politique de confidentialité", "conditions d'utilisation", "conditions générales d’utilisation",
               "Mentions légales", "MENTIONS LÉGALES", "activer JavaScript", "cliquez ici", "Abonnez-vous", "inscrivez-vous", "aller au contenu", "Partager sur Facebook", "partager sur Twitter", "suivez-nous", "retour en haut",
               "Todos los derechos reservados", "política de cookies", "POLÍTICA DE PRIVACIDAD", "Configuración de cookies", "aviso de cookies", "Términos y condiciones", "TÉRMINOS de uso", "términos de servicio", "Aviso legal", "active JavaScript",
               "activar javascript", "habilite JavaScript", "habilitar javascript", "haga clic aquí", "Haz clic AQUÍ", "Suscríbete ahora", "suscríbete a", "saltar al contenido", "compartir en Facebook", "compartir en Twitter", "síguenos en", "Volver arriba"]
    marks = [f"words {m * 3} here." for m in "#*$%&|<>»›·•"] + ["wow !!!!!! there."]
    marks += ["http://a.example https://b.example www.c.example.", "see https://a.example www.b.example http://c.example/d now."]
    plain = ["See http://a.example and https://b.example, then www.c.example, for more.", "Die Rechte der Leser und die Bedingungen bleiben.", "Les conditions du contrat, et son contenu.", "Los derechos de los lectores, y sus términos.",
             "Nothing of that kind is in this line.", "The cookie jar was back to its place.", "Straße, ÇA va et plus encore, İstanbul."]
    df = spark.createDataFrame([(f"{x}, and so on." if x in notices else x,) for x in notices + marks + plain], "t string")
    n = F.regexp_count("t", F.lit(quality.WORD))
    got = {r["t"]: r["f"] for r in df.select("t", quality.line_fails(F.col("t"), n, quality.Rules()).alias("f")).collect()}
    assert [t for t, f in got.items() if not f] == plain


def dice(a, b):
    grams = lambda x: set(zip(w := re.findall(r"[0-9a-z]+", x.lower()), w[1:]))
    a, b = grams(a), grams(b)
    return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0


def test_licences(spark, documents, edge_rows):
    mit = dict(licences.templates())["MIT"]
    rows = [*edge_rows, (30, "Some text.\nReleased under the MIT License.\nMore."), (31, mit), (32, mit.replace("furnished", "given").replace("\n", " ")), (33, "All rights reserved."), (34, "rights reserved all"), (35, f"Intro words here.\n\n{mit}\n\nEnd.")]
    got = {r["doc_id"]: r["matches"] for r in licences.licence_scan(documents(rows)).collect()}
    assert all(not got[i] for i in (1, 2, 3, 4, 5, 6, 7, 8, 34))
    assert [m["licence"] for m in got[30]] == ["MIT"] and [m["licence"] for m in got[33]] == ["LicenseRef-Reserved"]
    assert {m["licence"] for m in got[31]} == {"MIT"} and got[32][0]["dice"] > 0.9
    assert ("paragraph", "MIT") in {(m["unit"], m["licence"]) for m in got[35]}
    own = licences.Templates(licences.templates())
    for text in ("Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.", "a licence under the MIT", mit[:900]):
        want = min(((-d, k) for k, t in licences.templates() if (d := dice(text, t)) >= 0.8), default=None)
        best = own.best(text.lower().encode())
        assert (best is None) == (want is None) and (best is None or (round(-best[0], 9), best[1]) == (round(want[0], 9), want[1]))
    assert licences.licence_scan(documents(rows).limit(0)).count() == 0



def test_licences_in_passages(spark, documents):
    mit = " ".join(dict(licences.templates())["MIT"].split())
    three = mit.replace(" The above copyright", "\n\nThe above copyright").replace(" THE SOFTWARE IS", "\n\nTHE SOFTWARE IS")
    bsd = licence_texts.MORE_TEXTS["BSD-3-Clause"]
    words = " ".join(f"word{k}" for k in range(120))
    notice = "This text was released under the MIT License. Please see the file for the details."
    rows = [(1, three), (2, f"{words}\n\n{three}\n\n{words}"), (3, notice), (4, f"{words} {mit} {words} {notice}"), (5, bsd), (6, f"{words}\n\n{bsd}"), (7, "Any text.\nReleased under the MIT License.\nMore."), (8, f"{words} under the license of the MIT")]
    got = {r["doc_id"]: [(m["licence"], m["unit"]) for m in r["matches"]] for r in licences.licence_scan(documents(rows)).collect()}
    assert ("MIT", "passage") in got[2] and got[3] == [("MIT", "passage")] and got[4] == [("MIT", "passage")] * 2
    assert {k for k, _ in got[1]} == {"MIT"} and {k for k, _ in got[5]} == {k for k, _ in got[6]} == {"BSD-3-Clause"}
    assert got[7] == [("MIT", "line")] and got[8] == []


def test_passages_equal_brute_force():
    rnd = random.Random(8)
    own = licences.Templates([("A", "a b c d e"), ("B", "b c a c e f g"), ("C", "d d e")])
    for _ in range(300):
        text = [rnd.choice("abcdefgxy") for _ in range(rnd.randint(2, 30))]
        most = max(dice(" ".join(text[i:j]), t) for t in ("a b c d e", "b c a c e f g", "d d e") for i in range(len(text)) for j in range(i + 1, len(text) + 1))
        got = own.passages(" ".join(text).encode(), [])
        assert bool(got) == (most >= 0.8) and all(0.8 <= m["dice"] <= most + 1e-9 for m in got)


def test_url_filter(spark):
    urls = [(1, None), (2, ""), (3, "no scheme"), (4, "HTTP://WWW.Example.COM/en/x?q"), (5, "http://a.example.com/en/"), (6, "http://com/x"), (7, "http://acom.net/fr/1"), (8, "http://a.com"), (9, "x://b.net/es/2#f"), (10, "http://é.net/ES/"), (10, "http://é.net/ES/")]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in urls], "page_id bigint, url string, host string, items string")
    got = {r["page_id"]: r for r in url_filter.filter_urls(pages).collect()}
    assert [(got[i]["host"], got[i]["path"]) for i in (1, 2, 3)] == [("", "")] * 3
    assert (got[4]["host"], got[4]["path"], got[4]["rule"], got[4]["verdict"]) == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert (got[5]["rule"], got[5]["verdict"]) == ("example.com/en/", "block") and got[6]["rule"] == "com/"
    assert got[7]["rule"] == "net/fr/" and got[8]["rule"] is None and got[9]["verdict"] == "block" and got[10]["rule"] is None
    assert url_filter.filter_urls(pages).count() == len(urls)
    assert url_filter.filter_urls(pages.limit(0)).count() == 0
    alone = url_filter.filter_urls(pages.filter("page_id < 4"))
    assert {r["verdict"] for r in alone.collect()} == {"allow"}


def test_url_mining(spark):
    pages = spark.createDataFrame([(i, f"http://h{i}.example.com/{'en' if i % 2 else 'de'}/{i}") for i in range(40)] + [(100, "http://z.example.org/en/1"), (101, "http://z.example.org/de/1"), (102, "http://z.example.org/xx/1")], "page_id bigint, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.filter_urls(pages).collect()}
    assert (got[100], got[101], got[102]) == ("block", "allow", "allow")


def mined_verdict(rows, items, mining):
    """The best rule on any combination of tokens, by counting all of them. rows: (token set, label)."""
    best = None
    for k in range(1, len(items) + 1):
        for a in combinations(sorted(items), k):
            held = [v for x, v in rows if set(a) <= x]
            for v in {*held}:
                c = held.count(v)
                confidence, share = c / len(held), sum(1 for _, w in rows if w == v) / len(rows)
                if c >= mining.min_support * len(rows) and confidence >= mining.min_confidence and confidence / share > mining.over_lift:
                    best = max(best or (0, 0, ""), (confidence, c, v))
    return best[2] if best else mining.default


def tokens(host, path):
    labels = host.split(".")
    return {f"h:{x}" for x in labels} | {f"t:{labels[-1]}"} | {"p:" + re.sub("[0-9]+", "9", x) for x in path.split("/") if x}


def test_url_mining_equals_counting(spark):
    rng = random.Random(3)
    urls = [f"http://{rng.choice('abc')}.{rng.choice(['example', 'shop'])}.{rng.choice(['com', 'net', 'org'])}/{rng.choice(['en', 'fr', 'es'])}/{rng.choice(['x', 'y/z', 'p/q'])}/" for _ in range(160)]
    mining = url_filter.Mining(min_support=0.05, min_confidence=0.7)
    got = url_filter.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string"), mining=mining).collect()
    listed = [(tokens(r["host"], r["path"]), r["verdict"]) for r in got if r["rule"]]
    assert 40 < len(listed) < 150 and len({r["verdict"] for r in got if not r["rule"]}) == 2
    for r in got:
        if not r["rule"]:
            assert r["verdict"] == mined_verdict(listed, tokens(r["host"], r["path"]), mining), r


def test_url_template_counts_once(spark):
    """Thirty path parts that all urls of a site share would be a milliard of itemsets; any one of them finds the site."""
    shared = "/".join(f"part{chr(97 + k % 26)}{'z' * (k // 26)}" for k in range(30))
    urls = [(i, f"http://s{i}.net/es/{shared}/") for i in range(60)] + [(100 + i, f"http://t{i}.com/a/{i}") for i in range(60)] + [(200, "http://new.org/partb/"), (201, "http://new.org/other/")]
    pages = spark.createDataFrame(urls, "page_id bigint, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.filter_urls(pages).collect()}
    assert (got[200], got[201]) == ("block", "allow")


def test_url_rules_held_out(spark):
    pages = spark.createDataFrame([(i, f"http://h{i}.example.com/{'en' if i % 2 else 'de'}/{'abcdefgh'[i % 8] * 3}/") for i in range(400)], "page_id bigint, url string")
    got = {r["verdict"]: (r["n"], r["n_right"]) for r in url_filter.held_out(pages).collect()}
    assert set(got) == {"allow", "block"} and all(0 < n == right for n, right in got.values()) and sum(n for n, _ in got.values()) < 200
    assert url_filter.held_out(pages.limit(0)).count() == 0 and url_filter.held_out(spark.createDataFrame([(1, None)], "page_id bigint, url string")).count() == 0


def test_url_copies(spark, monkeypatch):
    """Sets with more copies than one row stands for are laid out whole."""
    monkeypatch.setattr(url_filter, "COPIES", 7)
    sets = spark.createDataFrame([(["a"], "block", 50), (["a", "b"], "allow", 21), ([], "allow", 29)], "classes array<string>, label string, n bigint")
    got = {(tuple(r["antecedent"]), r["verdict"]): (round(r["confidence"], 6), round(r["support"], 6)) for r in url_filter.mined_rules(sets, url_filter.Mining(0.01, 0.5)).collect()}
    assert got == {(("a",), "block"): (round(50 / 71, 6), 0.5), (("b",), "allow"): (1.0, 0.21), (("a", "b"), "allow"): (1.0, 0.21)}


def brute(text, items):
    words = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
    w, hit, whose = words(text), set(), set()
    for item, t in items:
        v = words(t)
        n = min(10, len(v))
        windows = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if n else set()
        for k in range(len(w) - n + 1) if n else ():
            if tuple(w[k : k + n]) in windows:
                whose.add(str(item))
                hit |= set(range(k, k + n))
    return len(w), len(hit), sorted(whose)


def test_decontamination(spark, documents, edge_rows):
    items = [(1, "One two three four five six seven eight nine ten eleven twelve"), (2, "tiny item"), (3, None), (4, "..."), (5, "tiny item"), (5, "tiny item"), (10, "日本語 x y")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = [*edge_rows, (40, "before ONE two, three four five six seven eight nine ten ELEVEN twelve after a tiny-item end"), (41, "one two three four five six seven eight nine x ten"), (42, "tiny tiny item item")]
    docs = documents(rows)
    for size in (1 << 20, 20):
        got = sorted((r["doc_id"] or -1, r["n_words"], r["n_hit"], r["items"]) for r in dc.scan(docs, bench, block_bytes=size).collect())
        assert got == sorted((i or -1, *brute(t, items)) for i, t in rows)
    cleaned = dc.decontaminate(docs, bench)
    assert cleaned.columns == docs.columns and cleaned.count() == len(rows) and dc.scan(cleaned, bench).filter("n_hit > 0").count() == 0
    text = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert text[40] == "before   after a   end" and text[41] == rows[-2][1] and text[1] is None
    assert dc.decontaminate(docs, bench, "documents").count() == sum(brute(t, items)[1] == 0 for _, t in rows)
    assert dc.scan(docs.limit(0), bench).count() == 0 and dc.scan(docs, bench.limit(0)).filter("n_hit > 0").count() == 0


def plainly_cut(text, items):
    """Hit words of all items out, a blank for each run, again until none is left."""
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x)
    lists = [pattern.findall(lower(t or "")) for _, t in items]
    while True:
        found = list(pattern.finditer(lower(text)))
        w, hit = [m[0] for m in found], set()
        for v in lists:
            n = min(10, len(v))
            windows = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if n else set()
            hit |= {k + j for k in range(len(w) - n + 1) if n and tuple(w[k : k + n]) in windows for j in range(n)}
        if not hit:
            return text
        for k in sorted(hit, reverse=True):
            if k - 1 not in hit:
                last = k
                while last + 1 in hit:
                    last += 1
                text = text[: found[k].start()] + " " + text[found[last].end() :]


def test_removal_is_that_of_one_block(spark, documents):
    """Cuts of one block's windows may join words to a window of another; several blocks end as one does."""
    rnd = random.Random(9)
    items = [(1, "a b c d"), (2, "x y"), (3, "p q r s t u v w x1 y1 z1"), (4, "m n"), (5, None), (6, "")]
    rows = [(1, "zero a b x y c d end"), (2, "a b x m n y c d"), (3, "A, B! c x y d"), (4, None), (5, ""), (6, "p q r s m n t u v w x1 y1 z1 tail"), (6, "no hit here")]
    rows += [(100 + k, " ".join(rnd.choice("a b c d x y m n p q".split()) for _ in range(rnd.randint(0, 40)))) for k in range(60)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents(rows).withColumn("n_chars", F.lit(-1).cast("long"))
    want = sorted((i or -1, None if t is None else plainly_cut(t, items)) for i, t in rows if t is not None)
    for size in (1 << 20, 9):
        got = dc.decontaminate(docs, bench, block_bytes=size)
        assert got.columns == docs.columns and got.filter("text IS NULL").count() == 1
        held = got.collect()
        assert sorted((r["doc_id"] or -1, r["text"]) for r in held if r["text"] is not None) == want
        before = {(i, t) for i, t in rows}
        assert all(r["n_chars"] == (-1 if (r["doc_id"], r["text"]) in before else len(r["text"])) for r in held if r["text"] is not None)
        assert dc.scan(got, bench, block_bytes=size).filter("n_hit > 0").isEmpty()
        left = dc.decontaminate(docs, bench, "documents", block_bytes=size)
        assert sorted((r["doc_id"], r["text"] or "") for r in left.collect()) == sorted((i, t or "") for i, t in rows if t is None or plainly_cut(t, items) == t)
    assert dc.decontaminate(docs.limit(0), bench, block_bytes=7).count() == 0
    assert dc.decontaminate(docs, bench.limit(0), block_bytes=7).count() == len(rows)


def test_the_driver_holds_one_block(spark):
    items = [(k, f"word{k} " * 12) for k in range(50)]
    parts = dc.Blocks(spark.createDataFrame(items, "item_id bigint, text string"), "item_id", "text", 400)
    sizes = [r["s"] for r in parts.rows.groupBy("block").agg(F.sum(F.octet_length("t")).alias("s")).collect()]
    assert parts.n > 5 and sum(sizes) == sum(len(t) for _, t in items) and max(sizes) <= 400 + max(len(t) for _, t in items)
    assert sum(1 for _ in parts.indexes(10)) == parts.n
