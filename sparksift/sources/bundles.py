"""Report files of a manifest: PDF with links, and workbooks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sheets import workbook
from .sinks import manifest as read_manifest
from .sinks import put

LINES_PER_PAGE = 50
LINE_CHARS = 120
#: Characters of a path, query or fragment that stay as they are; % too, so that encoded ones aren't encoded again.
SAFE = "/?#&=%:;,+@!$'*~.-_"


def link_target(url: str) -> str:
    """The url in ASCII: its host by IDNA, other characters beyond ASCII, blanks and brackets percent-encoded."""
    scheme, mark, rest = url.partition("://")
    host, path = (rest, "") if mark else ("", url)
    if mark and (cut := re.search(r"[/?#]", rest)):
        host, path = rest[: cut.start()], rest[cut.start() :]
    if not host.isascii():
        try:
            host = host.encode("idna").decode()
        except UnicodeError:
            host = quote(host, safe=":@[]")
    return f"{scheme if mark else ''}{mark}{host}{quote(path, safe=SAFE)}"


def wrapped(text: str, width: int = LINE_CHARS) -> list[str]:
    return [text[k : k + width] for k in range(0, len(text), width)] or [""]


def pdf(title: str, rows: list[tuple[str, str]]) -> bytes:
    """Pages of (text, url) lines; each url is a link, and long texts run over several lines. Text is Latin-1; other
    characters become question marks there, but not in links."""
    rows = [(line, url) for text, url in rows for line in wrapped(text)]
    safe = lambda x: x.encode("latin-1", "replace").decode("latin-1").replace("\\", r"\\").replace("(", r"\(").replace(")", r"\)")
    pages = [rows[k : k + LINES_PER_PAGE] for k in range(0, len(rows), LINES_PER_PAGE)] or [[]]
    objects: list[str] = ["", "", "<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica >>"]
    kids = []
    for page in pages:
        draw, notes = [f"BT /F1 12 Tf 40 800 Td ({safe(title)}) Tj ET"], []
        for n, (text, url) in enumerate(page):
            y = 780 - 15 * n
            draw.append(f"BT /F1 8 Tf 40 {y} Td ({safe(text)}) Tj ET")
            objects.append(f"<< /Type /Annot /Subtype /Link /Border [0 0 0] /Rect [40 {y - 2} 550 {y + 9}] /A << /S /URI /URI ({safe(link_target(url))}) >> >>")
            notes.append(f"{len(objects)} 0 R")
        body = "\n".join(draw)
        objects.append(f"<< /Length {len(body.encode('latin-1'))} >>\nstream\n{body}\nendstream")
        objects.append(f"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 595 842] /Resources << /Font << /F1 3 0 R >> >> /Contents {len(objects)} 0 R /Annots [{' '.join(notes)}] >>")
        kids.append(f"{len(objects)} 0 R")
    objects[0], objects[1] = "<< /Type /Catalog /Pages 2 0 R >>", f"<< /Type /Pages /Kids [{' '.join(kids)}] /Count {len(kids)} >>"
    out, at = b"%PDF-1.4\n", []
    for n, o in enumerate(objects, 1):
        at.append(len(out))
        out += f"{n} 0 obj\n{o}\nendobj\n".encode("latin-1")
    xref = "".join(f"{x:010d} 00000 n \n" for x in at)
    return out + f"xref\n0 {len(at) + 1}\n0000000000 65535 f \n{xref}trailer\n<< /Size {len(at) + 1} /Root 1 0 R >>\nstartxref\n{len(out)}\n%%EOF\n".encode("latin-1")


def pdf_links(data: bytes) -> list[str]:
    """Targets of the links of a file that `pdf` made, in order, each run of equal ones once."""
    found = [re.sub(r"\\([\\()])", r"\1", x.decode("latin-1")) for x in re.findall(rb"/URI \(((?:[^\\()]|\\.)*)\)", data)]
    return [x for k, x in enumerate(found) if not k or found[k - 1] != x]


RENDERED = "bundle string, part_no long, pdf binary, xlsx binary"
Frames = Iterator[pd.DataFrame]


def rendered(manifest: DataFrame, then: Callable[[Frames], Frames] | None = None, schema: str = RENDERED) -> DataFrame:
    """bundle, part_no, host, url and, if there is one, evidence array to bundle, part_no, pdf, xlsx (binary). A part is bounded by the caps of the split.

    In the PDF a url's evidence follows it, line by line; in the workbook it is a column, and urls are hyperlinks. `then`
    takes the files on, to rows of schema, in the task that made them and one part at a time: a step of its own would be
    handed thousands of files at once, since Spark counts the rows of a batch and not their bytes.
    """
    if "evidence" not in manifest.columns:
        manifest = manifest.withColumn("evidence", F.array().cast("array<string>"))

    def run(frames: Frames) -> Frames:
        key, rows = None, []

        def close():
            lines = [x for h, u, e in rows for x in ((f"{h}  {u}", u), *((f"    evidence: {r}", r) for r in e))]
            links = {n: link_target(u) for n, (_, u, _) in enumerate(rows, 1)}
            sheet = workbook(["host", "url", "evidence"], [[h, u, ", ".join(e)] for h, u, e in rows], links)
            return pd.DataFrame([{"bundle": key[0], "part_no": key[1], "pdf": pdf(f"{key[0]} part {key[1]}", lines), "xlsx": sheet}])

        for f in frames:
            for b, p, h, u, e in zip(f["bundle"], f["part_no"], f["host"], f["url"], f["evidence"]):
                if key != (b, p):
                    if rows:
                        yield close()
                    key, rows = (b, p), []
                rows.append((h, u, list(e) if e is not None else []))
        if rows:
            yield close()

    dealt = manifest.select("bundle", "part_no", "host", "url", "evidence").repartition("bundle", "part_no").sortWithinPartitions("bundle", "part_no", "url")
    return dealt.mapInPandas((lambda frames: then(run(frames))) if then else run, schema)


def put_bundles(manifest: DataFrame, path: str) -> DataFrame:
    """The PDF and the workbook of each part as files under path, all or none; gives their manifest: bundle, part_no, name, bytes, sha256, file."""
    named = lambda kind: F.concat(F.regexp_replace(F.coalesce("bundle", F.lit("none")), r"[^A-Za-z0-9.-]", "_"), F.lit("-"), F.col("part_no"), F.lit(f".{kind}")).alias("name")
    both = F.explode(F.array(*[F.struct(named(kind), F.col(kind).alias("content")) for kind in ("pdf", "xlsx")]))
    put(rendered(manifest).select("bundle", "part_no", both.alias("f")).select("bundle", "part_no", "f.name", "f.content"), path)
    return read_manifest(manifest.sparkSession, path, "bundle string, part_no bigint")
