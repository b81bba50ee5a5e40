"""Declared schemas, keys and canonical column orders."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


BILLS = T.StructType(_strings("atto_id", "legislatura"))
BILL_SIGNERS = T.StructType(
    _strings("atto_id", "nome", "genere") + [T.StructField("primo_firmatario", T.BooleanType())]
)
ARTICLES = T.StructType(
    _strings("atto_id", "articolo_id", "numero_articolo", "titolo", "versione", "testo_integrale")
)
AMENDMENTS = T.StructType(
    _strings("atto_id", "emendamento_id", "numero_emendamento", "articolo_target")
    + [T.StructField("data", T.DateType())]
    + _strings("target_info", "testo_emendamento")
)
PROPONENTS = T.StructType(
    _strings(
        "emendamento_id", "proponente_id", "proponente_nome", "proponente_gruppo", "proponente_genere"
    )
)
SENATORS = T.StructType(
    _strings("senatore_id", "full_name", "first_name", "last_name", "gender")
    + [T.StructField("birth_date", T.DateType())]
    + _strings("gruppo_nome")
    + [T.StructField("gruppo_inizio", T.DateType()), T.StructField("gruppo_fine", T.DateType())]
    + _strings("gruppo_uri")
)

TABLES = {
    "t_atti": BILLS,
    "t_firmatari_atto": BILL_SIGNERS,
    "t_articoli": ARTICLES,
    "t_emendamenti": AMENDMENTS,
    "t_proponenti": PROPONENTS,
    "t_senatori": SENATORS,
}
KEYS = {
    "t_atti": ["atto_id"],
    "t_articoli": ["atto_id", "articolo_id", "versione"],
    "t_emendamenti": ["emendamento_id"],
}

TRIPLES = T.StructType(_strings("s", "p", "o", "o_kind", "o_datatype"))

MEMBERSHIP = T.StructType(_strings("uri", "nome", "inizio", "fine", "sigla"))
PERSON = T.StructType(
    _strings("id", "uri", "full_name", "first_name", "last_name", "gender", "birth_date")
    + [T.StructField("gruppi", T.ArrayType(MEMBERSHIP))]
)

PARAGRAPH = T.StructType(_strings("num", "text"))
ARTICLE = T.StructType(
    _strings("id", "num", "heading") + [T.StructField("paragraphs", T.ArrayType(PARAGRAPH))]
)
SIGNER = T.StructType(
    _strings("id", "name", "genere") + [T.StructField("primo_firmatario", T.BooleanType())]
)
PARSED_BILL = T.StructType(
    _strings("path", "date", "number", "type")
    + [
        T.StructField("proponents", T.ArrayType(SIGNER)),
        T.StructField("articles", T.ArrayType(ARTICLE)),
    ]
    + _strings("error")
)
PROPONENT = T.StructType(_strings("id", "name", "href"))
PARSED_AMENDMENT = T.StructType(
    _strings("path", "id", "date", "number", "name", "target_ddl", "target_ddl_showAs", "target_info")
    + [
        T.StructField("proponents", T.ArrayType(PROPONENT)),
        T.StructField("content", T.ArrayType(T.StringType())),
    ]
    + _strings("error")
)

# Canonical column orders of the wide tables.
BILL_PHASE_COLUMNS = (
    "id_fase id_ddl_interno id_fase_sparql uri_ddl legislatura progressivo_iter is_prima_fase "
    "numero_fase fase ramo_origine titolo data_presentazione stato_ddl data_stato_ddl "
    "presentato_trasmesso natura descr_iniziativa urn_testo_presentato has_testo_presentato "
    "urn_testo_approvato has_testo_approvato n_emendamenti n_emendamenti_akn has_emendamenti "
    "has_emendamenti_akn tipo_iniziativa uri_primo_firmatario nome_primo_firmatario "
    "gruppo_primo_firmatario_uri gruppo_primo_firmatario_nome gruppo_primo_firmatario_sigla "
    "n_cofirmatari n_cofirmatari_totale fonte data_fetch"
).split()
SENATE_SIGNER_COLUMNS = (
    "id_fase legislatura uri_iniziativa is_primo_firmatario uri_senatore nome_senatore "
    "tipo_iniziativa data_firma data_ritiro_firma gruppo_uri gruppo_nome gruppo_sigla carica_gruppo"
).split()
CHAMBER_ACT_COLUMNS = (
    "id_atto id_numerico legislatura titolo data_presentazione tipo_atto natura iniziativa "
    "primo_firmatario_uri primo_firmatario_nome n_cofirmatari stato_iter data_stato_iter "
    "data_prima_assegnazione data_approvazione url_testo_presentato has_testo url_scheda_camera "
    "fonte data_fetch"
).split()
CHAMBER_SIGNER_COLUMNS = (
    "id_atto legislatura uri_deputato nome_deputato is_primo_firmatario gruppo_uri gruppo_nome "
    "gruppo_sigla data_fetch"
).split()
COALITION_COLUMNS = (
    "legislatura pol_party sigla giornialgoverno governo giornipm primoministro governo_nome maggioranza"
).split()
