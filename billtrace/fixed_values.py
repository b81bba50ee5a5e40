"""They must be exactly these for results to be right.

Nothing here is logic. Operators take every one of these as a default
argument, so another parliament can pass its own.
"""

# Broken UTF-8 sequences and what they stand for, applied in this order.
MOJIBAKE = [
    ("Ã\u00a0", "à"),
    ("Ã¨", "è"),
    ("Ã©", "é"),
    ("Ã¬", "ì"),
    ("Ã²", "ò"),
    ("Ã¹", "ù"),
    ("Ã ", "À"),
    ("Ãˆ", "È"),
    ("Ã‰", "É"),
    ("ÃŒ", "Ì"),
    ("Ã’", "Ò"),
    ("Ã™", "Ù"),
    ("â\u0080\u0093", "-"),
    ("â\u0080\u0094", "-"),
    ("â\u0080\u009c", '"'),
    ("â\u0080\u009d", '"'),
    ("â\u0080\u0098", "'"),
    ("â\u0080\u0099", "'"),
    ("â\u0080¦", "..."),
    ("â\u0082¬", "€"),
    ("Â«", "«"),
    ("Â»", "»"),
    ("â€‰", " "),
    ("â€¯", " "),
    ("Ã¯", "ï"),
]

# Document kinds of an act folder, and the versions of a bill.
DOCUMENT_KINDS = ["ddlcomm", "ddlmess", "ddlpres", "emend", "emendc", "resaula", "sommcomm"]
BILL_VERSIONS = ["ddlpres", "ddlcomm", "ddlmess"]
START_VERSION = "ddlpres"
END_VERSION = "ddlmess"

# Label of a person who is known but belongs to no group on the date.
NO_GROUP = "Misto / Sconosciuto"

# Prefix of an amendment number.
AMENDMENT_PREFIX = "Emendamento n."

# Labels of the two procedure states that carry a date of interest.
LABEL_ASSIGNED = "Da assegnare"
LABEL_APPROVED = "Approvato definitivamente. Legge"

# Provenance of the two chambers.
SOURCE_SENATO = "sparql:dati.senato.it"
SOURCE_CAMERA = "sparql:dati.camera.it"

# Patterns of a reference to another norm.
NORM_REFERENCES = [
    r"legge \d+ del \d{4}",
    r"decreto legislativo \d+/\d{4}",
    r"art\. \d+",
    r"d\.l\. \d+",
]

# Words showing that a page holds parliamentary content.
CONTENT_WORDS = [
    "emendament",
    "proposta",
    "articolo",
    "comma",
    "disegno di legge",
    "legislatur",
    "testo",
]

# Parts of a predicate name that hint at a date, and at a signatory.
DATE_WORDS = ["data", "date", "inizio", "fine", "quando", "time"]
SIGNATORY_WORDS = [
    "firm",
    "senat",
    "present",
    "propon",
    "autor",
    "sign",
    "membro",
    "componente",
    "deputato",
    "parlamentar",
]

# Namespaces and the prefixes that shorten them.
NAMESPACES = {
    "http://dati.camera.it/ocd/": "ocd:",
    "http://dati.senato.it/osr/": "osr:",
    "http://purl.org/dc/elements/1.1/": "dc:",
    "http://www.w3.org/2000/01/rdf-schema#": "rdfs:",
    "http://www.w3.org/1999/02/22-rdf-syntax-ns#": "rdf:",
}
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
AKOMA_NTOSO = "http://docs.oasis-open.org/legaldocml/ns/akn/3.0/CSD03"

# Parliamentary groups of each legislature, by short name.
GROUPS = {
    13: [
        "AN",
        "Comunista",
        "Democrazia Europea",
        "DS-U",
        "FI",
        "LSP-PSd'Az",
        "Misto",
        "PPI",
        "Rin.Ld.Ind-Pop.",
        "Rinnovam.Ital.",
        "Rinn.Ital.e.Ind.",
        "UDEUR",
        "UDC",
        "Verdi-Un",
    ],
    14: [
        "AN",
        "Aut",
        "DS-U",
        "FI",
        "LSP-PSd'Az",
        "Mar-DL-U",
        "Misto",
        "UDC",
        "Verdi-Un",
    ],
    15: [
        "AN",
        "Aut",
        "DCA-PRI-MPA",
        "FI",
        "IU-Verdi-Com",
        "LSP-PSd'Az",
        "Misto",
        "PD-IDP",
        "RC-SE",
        "SDSE",
        "UDC",
    ],
    16: [
        "CN:GS-SI-PID-IB-FI",
        "FDI-CDN",
        "FI-BP-PPE",
        "FLI",
        "IdV",
        "LSP-PSd'Az",
        "Misto",
        "PD-IDP",
        "Per il Terzo Polo:ApI-FLI-CD",
        "UDC-SVP-AUT:UV-MAIE-VN-MRE-PLI-PSI",
    ],
    17: [
        "ALA-PRI",
        "AP-CpE-NCD",
        "Art.1-MDP-LeU",
        "Aut(SVP-PATT,Cb)",
        "CoR",
        "FL(Id-PL,PLI)",
        "FI-BP-PPE",
        "GAL-UDC",
        "LSP-PSd'Az",
        "Misto",
        "M5S",
        "NcI",
        "PD-IDP",
        "PI",
        "SCpI",
    ],
    18: [
        "Aut(SVP-PATT,Cb)",
        "C.A.L.-Idv",
        "Europeisti-MAIE-CD",
        "FI-BP-PPE",
        "FdI",
        "Ipf-CD",
        "IV-PSI",
        "LSP-PSd'Az",
        "Misto",
        "M5S",
        "PD-IDP",
        "UpC-CAL-Alt-PC-AI-Pr.SMART-IdV",
    ],
    19: [
        "Aut(SVP-PATT,Cb)",
        "Cd'I-UDC-NM(NcI,CI,IaC)-MAIE-CP",
        "FI-BP-PPE",
        "FdI",
        "IV-C-RE",
        "LSP-PSd'Az",
        "Misto",
        "M5S",
        "PD-IDP",
    ],
}

# Governments as (legislature, name, start, end, group of the prime minister, majority).
GOVERNMENTS = [
    (
        13, "Prodi I", "1996-05-17", "1998-10-21", "DS-U",
        ["DS-U", "PPI", "Rinnovam.Ital.", "Rinn.Ital.e.Ind.", "Verdi-Un", "Rin.Ld.Ind-Pop."],
    ),
    (
        13, "D'Alema I", "1998-10-21", "1999-12-22", "DS-U",
        ["DS-U", "PPI", "Rinnovam.Ital.", "Rinn.Ital.e.Ind.", "UDEUR", "Democrazia Europea"],
    ),
    (
        13, "D'Alema II", "1999-12-22", "2000-04-26", "DS-U",
        ["DS-U", "PPI", "Rinnovam.Ital.", "UDEUR", "Democrazia Europea"],
    ),
    (
        13, "Amato II", "2000-04-26", "2001-06-11", "DS-U",
        ["DS-U", "PPI", "UDEUR", "Democrazia Europea", "Verdi-Un"],
    ),
    (
        14, "Berlusconi II", "2001-06-11", "2005-04-20", "FI",
        ["FI", "AN", "LSP-PSd'Az", "UDC", "Aut"],
    ),
    (
        14, "Berlusconi III", "2005-04-20", "2006-05-17", "FI",
        ["FI", "AN", "LSP-PSd'Az", "UDC", "Aut"],
    ),
    (
        15, "Prodi II", "2006-05-17", "2008-05-08", "PD-IDP",
        ["PD-IDP", "RC-SE", "IU-Verdi-Com", "SDSE", "Aut"],
    ),
    (
        16, "Berlusconi IV", "2008-05-08", "2011-11-16", "FI-BP-PPE",
        ["FI-BP-PPE", "LSP-PSd'Az", "CN:GS-SI-PID-IB-FI"],
    ),
    (
        16, "Monti", "2011-11-16", "2013-04-28", None,
        ["PD-IDP", "FI-BP-PPE", "UDC-SVP-AUT:UV-MAIE-VN-MRE-PLI-PSI", "Per il Terzo Polo:ApI-FLI-CD"],
    ),
    (
        17, "Letta", "2013-04-28", "2014-02-22", "PD-IDP",
        ["PD-IDP", "AP-CpE-NCD", "GAL-UDC", "SCpI", "PI", "Aut(SVP-PATT,Cb)"],
    ),
    (
        17, "Renzi", "2014-02-22", "2016-12-12", "PD-IDP",
        ["PD-IDP", "AP-CpE-NCD", "GAL-UDC", "Aut(SVP-PATT,Cb)", "ALA-PRI", "NcI"],
    ),
    (
        17, "Gentiloni", "2016-12-12", "2018-06-01", "PD-IDP",
        ["PD-IDP", "AP-CpE-NCD", "GAL-UDC", "Aut(SVP-PATT,Cb)", "ALA-PRI", "NcI"],
    ),
    (
        18, "Gentiloni (reggenza)", "2018-03-23", "2018-06-01", "PD-IDP",
        ["PD-IDP", "Aut(SVP-PATT,Cb)"],
    ),
    (
        18, "Conte I", "2018-06-01", "2019-09-05", "M5S",
        ["M5S", "LSP-PSd'Az"],
    ),
    (
        18, "Conte II", "2019-09-05", "2021-02-13", "M5S",
        ["M5S", "PD-IDP", "IV-PSI", "Europeisti-MAIE-CD"],
    ),
    (
        18, "Draghi", "2021-02-13", "2022-10-22", None,
        ["PD-IDP", "M5S", "LSP-PSd'Az", "FI-BP-PPE", "IV-PSI", "Aut(SVP-PATT,Cb)", "Europeisti-MAIE-CD", "Ipf-CD"],
    ),
    (
        19, "Meloni", "2022-10-22", None, "FdI",
        ["FdI", "FI-BP-PPE", "LSP-PSd'Az", "Cd'I-UDC-NM(NcI,CI,IaC)-MAIE-CP"],
    ),
]
