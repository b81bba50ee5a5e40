"""Akoma Ntoso files to nested rows.

XML mixes text and tags inside headings and paragraphs, and the text must come out in
document order, which no built-in reader keeps. So the files go through ``mapInPandas``,
one small document at a time; everything after it is built-in. A file that does not parse
becomes a row with ``error`` set, and the job goes on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..fixed_values import AKOMA_NTOSO
from ..schemas import PARSED_AMENDMENT, PARSED_BILL

_NS = {"an": AKOMA_NTOSO}


def _attr(root, path: str, name: str):
    node = root.find(path, _NS)
    return None if node is None else node.get(name)


def _flat(node) -> str:
    return "" if node is None else "".join(node.itertext()).strip()


def _own_text(node) -> str:
    return (node.text or "").strip() if node is not None else ""


def _number(node) -> str:
    num = node.find("an:num", _NS)
    return "" if num is None else (num.text or "")


def _paragraph(node) -> dict:
    num, text = _number(node), _flat(node)
    return {"num": num, "text": text.removeprefix(num).strip() if num else text}


def _article(node) -> dict:
    return {
        "id": node.get("id"),
        "num": _number(node),
        "heading": _flat(node.find("an:heading", _NS)),
        "paragraphs": [_paragraph(p) for p in node.iterfind(".//an:paragraph", _NS)],
    }


def bill_row(root) -> dict:
    """Identification, signers and articles of a bill."""
    labels = {
        (kind, node.get("id", "")): node.get("showAs", "")
        for kind in ("TLCPerson", "TLCRole")
        for node in root.iterfind(f".//an:{kind}", _NS)
    }
    signers = []
    for node in root.iterfind(".//an:docProponent", _NS):
        person = node.get("refersTo", "").lstrip("#")
        role = labels.get(("TLCRole", node.get("as", "").lstrip("#")), "")
        signers.append(
            {
                "id": person,
                "name": labels.get(("TLCPerson", person)) or _own_text(node),
                "genere": "F" if "Senatrice" in role else "M",
                "primo_firmatario": not signers,
            }
        )
    return {
        "date": _attr(root, ".//an:FRBRWork/an:FRBRdate", "date"),
        "number": _attr(root, ".//an:FRBRWork/an:FRBRnumber", "value"),
        "type": _attr(root, ".//an:FRBRWork/an:FRBRsubtype", "value"),
        "proponents": signers,
        "articles": [_article(a) for a in root.iterfind(".//an:body//an:article", _NS)],
    }


def amendment_row(root) -> dict:
    """Identification, target bill, proponents and content of an amendment."""
    people = {node.get("id"): node for node in root.iterfind(".//an:references/an:TLCPerson", _NS)}
    proponents = []
    for node in root.iterfind(".//an:preface//an:docProponent", _NS):
        ref = node.get("refersTo", "").lstrip("#")
        listed = people.get(ref)
        name = _own_text(node) if listed is None else listed.get("showAs")
        proponents.append({"id": ref, "name": name, "href": None if listed is None else listed.get("href")})
    texts = [_flat(p) for p in root.iterfind(".//an:amendmentBody//an:p", _NS)]
    work = ".//an:FRBRWork"
    known = root.find(work, _NS) is not None

    def field(tag: str, name: str):
        return (_attr(root, f"{work}/an:{tag}", name) or "") if known else None

    return {
        "id": field("FRBRthis", "value"),
        "date": field("FRBRdate", "date"),
        "number": field("FRBRnumber", "value"),
        "name": field("FRBRname", "value"),
        "target_ddl": _attr(root, ".//an:references/an:activeRef", "href"),
        "target_ddl_showAs": _attr(root, ".//an:references/an:activeRef", "showAs"),
        "target_info": _own_text(root.find(".//an:preface/an:p/an:docNumber", _NS)),
        "proponents": proponents,
        "content": [t for t in texts if t],
    }


def _parse_files(files: DataFrame, to_row: Callable, schema: T.StructType) -> DataFrame:
    names = schema.fieldNames()

    def one(path: str, content: bytes) -> dict:
        row = dict.fromkeys(names)
        try:
            row.update(to_row(ElementTree.fromstring(bytes(content))))
        except Exception as exc:  # a broken file is data, not a failure of the job
            row["error"] = f"{type(exc).__name__}: {exc}"
        row["path"] = path
        return row

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [one(p, c) for p, c in zip(frame["path"], frame["content"])]
            yield pd.DataFrame(rows, columns=names)

    return files.select("path", "content").mapInPandas(batches, schema)


def parse_bills(files: DataFrame) -> DataFrame:
    """Bill files (path, content) to nested rows."""
    return _parse_files(files, bill_row, PARSED_BILL)


def parse_amendments(files: DataFrame) -> DataFrame:
    """Amendment files (path, content) to nested rows."""
    return _parse_files(files, amendment_row, PARSED_AMENDMENT)
