"""Census registers: delimited lines to the eleven target tables. Every projection is one select of a declared list; nothing shuffles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.functions.scalars import float_text, safe_int, strip, whole_part

# The columns of each target table in order, how each is read, and the source field.
# str: text; int: whole number or null; trunc: number cut to its whole part; num: number as text; itext: whole number as text;
# null, nullint: always null, as text or as a whole number.
TARGETS = {
    "cuarcuiu": (
        ("codice", "str", "codice_ammvo"),
        ("sezione", "str", "sezione"),
        ("immobile", "int", "identificativo_immobile"),
        ("tipo_imm", "str", "tipo_immobile"),
        ("progressiv", "int", "progressivo"),
        ("zona", "str", "zona"),
        ("categoria", "str", "categoria"),
        ("classe", "str", "classe"),
        ("consistenz", "num", "consistenza"),
        ("superficie", "num", "superficie"),
        ("rendita_l", "num", "rendita_lire"),
        ("rendita_e", "num", "rendita_euro"),
        ("lotto", "str", "lotto"),
        ("edificio", "str", "edificio"),
        ("scala", "str", "scala"),
        ("interno_1", "str", "interno1"),
        ("interno_2", "str", "interno2"),
        ("piano_1", "str", "piano1"),
        ("piano_2", "str", "piano2"),
        ("piano_3", "str", "piano3"),
        ("piano_4", "str", "piano4"),
        ("gen_eff", "str", "data_di_efficacia00"),
        ("gen_regist", "str", "data_di_registrazione00"),
        ("gen_tipo", "str", "tipo_nota00"),
        ("gen_numero", "str", "numero_nota00"),
        ("gen_progre", "str", "progressivo_nota00"),
        ("gen_anno", "str", "anno_nota00"),
        ("con_eff", "str", "data_di_efficacia99"),
        ("con_regist", "str", "data_di_registrazione99"),
        ("con_tipo", "str", "tipo_nota99"),
        ("con_numero", "str", "numero_nota99"),
        ("con_progre", "str", "progressivo_nota99"),
        ("con_anno", "str", "anno_nota99"),
        ("partita", "str", "partita"),
        ("annotazion", "str", "annotazione"),
        ("mutaz_iniz", "int", "identificativo_mutazione_iniziale"),
        ("mutaz_fine", "int", "identificativo_mutazione_finale"),
        ("prot_notif", "str", "protocollo_notifica"),
        ("data_notif", "str", "data_notifica"),
        ("gen_causa", "str", "codice_causale_atto_generante"),
        ("gen_descr", "str", "descrizione_atto_generante"),
        ("con_causa", "str", "codice_causale_atto_conclusivo"),
        ("con_descr", "str", "descrizione_atto_conclusivo"),
        ("flag_class", "str", "flag_classamento"),
    ),
    "cuindiri": (
        ("codice", "str", "codice_ammvo"),
        ("sezione", "str", "sezione"),
        ("immobile", "int", "identificativo_immobile"),
        ("tipo_imm", "str", "tipo_immobile"),
        ("progressiv", "int", "progressivo"),
        ("toponimo", "int", "toponimo"),
        ("indirizzo", "str", "indirizzo"),
        ("civico1", "str", "civico1"),
        ("civico2", "str", "civico2"),
        ("civico3", "str", "civico3"),
        ("cod_strada", "str", "codice_strada"),
    ),
    "cuidenti": (
        ("codice", "str", "codice_ammvo"),
        ("sezione", "str", "sezione"),
        ("immobile", "int", "identificativo_immobile"),
        ("tipo_imm", "str", "tipo_immobile"),
        ("progressiv", "int", "progressivo"),
        ("sez_urbana", "str", "sezione_urbana"),
        ("foglio", "str", "foglio"),
        ("numero", "str", "numero"),
        ("denominato", "int", "denominatore"),
        ("subalterno", "str", "subalterno"),
        ("edificiale", "null", None),
    ),
    "curiserv": (
        ("codice", "str", "codice_ammvo"),
        ("sezione", "str", "sezione"),
        ("immobile", "int", "identificativo_immobile"),
        ("tipo_imm", "str", "tipo_immobile"),
        ("progressiv", "int", "progressivo"),
        ("riserva", "str", "codice_riserva"),
        ("iscrizione", "str", "partita_iscrizione_riserva"),
    ),
    "ctpartic": (
        ("codice", "str", "codice_ammvo"),
        ("sezione", "str", "sezione"),
        ("immobile", "int", "identificativo_immobile"),
        ("tipo_imm", "str", "tipo_immobile"),
        ("progressiv", "int", "progressivo"),
        ("foglio", "int", "foglio"),
        ("numero", "str", "numero"),
        ("denominato", "int", "denominatore"),
        ("subalterno", "str", "subalterno"),
        ("edificiale", "str", "edificialita"),
        ("qualita", "int", "qualita"),
        ("classe", "str", "classe"),
        ("ettari", "trunc", "ettari"),
        ("are", "trunc", "are"),
        ("centiare", "trunc", "centiare"),
        ("flag_redd", "str", "flag_reddito"),
        ("flag_porz", "str", "flag_porzione"),
        ("flag_deduz", "str", "flag_deduzioni"),
        ("dominic_l", "num", "reddito_dominicale_lire"),
        ("agrario_l", "num", "reddito_agrario_lire"),
        ("dominic_e", "num", "reddito_dominicale_euro"),
        ("agrario_e", "num", "reddito_agrario_euro"),
        ("gen_eff", "str", "data_di_efficacia00"),
        ("gen_regist", "str", "data_di_registrazione00"),
        ("gen_tipo", "str", "tipo_nota00"),
        ("gen_numero", "str", "numero_nota00"),
        ("gen_progre", "str", "progressivo_nota00"),
        ("gen_anno", "int", "anno_nota00"),
        ("con_eff", "null", None),
        ("con_regist", "null", None),
        ("con_tipo", "null", None),
        ("con_numero", "null", None),
        ("con_progre", "null", None),
        ("con_anno", "nullint", None),
        ("partita", "str", "partita"),
        ("annotazion", "str", "annotazione"),
        ("mutaz_iniz", "int", "identificativo_mutazione_iniziale"),
        ("mutaz_fine", "int", "identificativo_mutazione_finale"),
        ("gen_causa", "str", "codice_causale_atto_generante"),
        ("gen_descr", "str", "descrizione_atto_generante"),
        ("con_causa", "str", "codice_causale_atto_conclusivo"),
        ("con_descr", "str", "descrizione_atto_conclusivo"),
    ),
    "ctdeduzi": (
        ("codice", "str", "codice_ammvo"),
        ("sezione", "str", "sezione"),
        ("immobile", "int", "identificativo_immobile"),
        ("tipo_imm", "str", "tipo_immobile"),
        ("progressiv", "int", "progressivo"),
        ("deduzione", "str", "simbolo_deduzione"),
    ),
    "ctriserv": (
        ("codice", "str", "codice_ammvo"),
        ("sezione", "str", "sezione"),
        ("immobile", "int", "identificativo_immobile"),
        ("tipo_imm", "str", "tipo_immobile"),
        ("progressiv", "int", "progressivo"),
        ("riserva", "str", "codice_riserva"),
        ("iscrizione", "str", "partita_iscrizione_riserva"),
    ),
    "ctporzio": (
        ("codice", "str", "codice_ammvo"),
        ("sezione", "str", "sezione"),
        ("immobile", "int", "identificativo_immobile"),
        ("tipo_imm", "str", "tipo_immobile"),
        ("progressiv", "int", "progressivo"),
        ("porzione", "str", "identificativo_porzione"),
        ("qualita", "int", "qualita"),
        ("classe", "str", "classe"),
        ("ettari", "trunc", "ettari"),
        ("are", "trunc", "are"),
        ("centiare", "trunc", "centiare"),
        ("dominic_e", "null", None),
        ("agrario_e", "null", None),
    ),
    "cttitola": (
        ("codice", "str", "codice_ammvo"),
        ("sezione", "str", "sezione"),
        ("soggetto", "int", "identificativo_soggetto"),
        ("tipo_sog", "str", "tipo_soggetto"),
        ("immobile", "int", "identificativo_immobile"),
        ("tipo_imm", "str", "tipo_immobile"),
        ("diritto", "str", "codice_diritto"),
        ("titolo", "str", "titolo_non_codificato"),
        ("numeratore", "int", "quota_numeratore"),
        ("denominato", "int", "quota_denominatore"),
        ("regime", "itext", "regime"),
        ("rif_regime", "int", "soggetto_di_riferimento"),
        ("gen_valida", "str", "data_di_validita00"),
        ("gen_nota", "str", "tipo_nota00"),
        ("gen_numero", "str", "numero_nota00"),
        ("gen_progre", "str", "progressivo_nota00"),
        ("gen_anno", "str", "anno_nota00"),
        ("gen_regist", "str", "data_registrazione_atti00"),
        ("partita", "str", "partita"),
        ("con_valida", "str", "data_di_validita99"),
        ("con_nota", "str", "tipo_nota99"),
        ("con_numero", "str", "numero_nota99"),
        ("con_progre", "str", "progressivo_nota99"),
        ("con_anno", "str", "anno_nota99"),
        ("con_regist", "str", "data_registrazione_atti99"),
        ("mutaz_iniz", "int", "identificativo_mutazione_iniziale"),
        ("mutaz_fine", "int", "identificativo_mutazione_finale"),
        ("identifica", "int", "identificativo_titolarita"),
        ("gen_causa", "str", "codice_causale_atto_generante"),
        ("gen_descr", "str", "descrizione_atto_generante"),
        ("con_causa", "str", "codice_causale_atto_conclusivo"),
        ("con_descr", "str", "descrizione_atto_conclusivo"),
    ),
    "ctfisica": (
        ("codice", "str", "codice_ammvo"),
        ("sezione", "str", "sezione"),
        ("soggetto", "int", "identificativo_soggetto"),
        ("tipo_sog", "str", "tipo_soggetto"),
        ("cognome", "str", "cognome"),
        ("nome", "str", "nome"),
        ("sesso", "str", "sesso"),
        ("data", "str", "data_di_nascita"),
        ("luogo", "str", "luogo_di_nascita"),
        ("codfiscale", "str", "codice_fiscale"),
        ("supplement", "str", "info_suppl"),
    ),
    "ctnonfis": (
        ("codice", "str", "codice_ammvo"),
        ("sezione", "str", "sezione"),
        ("soggetto", "int", "identificativo_soggetto"),
        ("tipo_sog", "str", "tipo_soggetto"),
        ("codfiscale", "str", "codice_fiscale"),
        ("denominaz", "str", "denominazione"),
        ("sede", "str", "sede"),
    ),
}
#: Register and record type that each target is made of; subjects and entitlements have one record type.
ORIGINS = {
    "cuarcuiu": ("FAB", "1"),
    "cuindiri": ("FAB", "3"),
    "cuidenti": ("FAB", "4"),
    "curiserv": ("FAB", "5"),
    "ctpartic": ("TER", "1"),
    "ctdeduzi": ("TER", "2"),
    "ctriserv": ("TER", "3"),
    "ctporzio": ("TER", "4"),
    "cttitola": ("TIT", None),
    "ctfisica": ("SOG", None),
    "ctnonfis": ("SOG", None),
}
REGISTERS = {"FAB": "FABBRICATI", "TER": "TERRENI", "SOG": "SOGGETTI", "TIT": "TITOLARITA"}
# Fields that a record may lack, in all registers, and those of one register only. All others are required.
OPTIONAL = ("sezione", "codice_causale_atto_generante", "descrizione_atto_generante", "codice_causale_atto_conclusivo", "descrizione_atto_conclusivo")
OPTIONAL_OF = {
    "FAB": ("flag_classamento",),
    "TER": (),
    "SOG": ("cognome", "nome", "sesso", "data_di_nascita", "luogo_di_nascita", "info_suppl", "denominazione", "sede"),
    "TIT": ("identificativo_titolarita",),
}


@dataclass(frozen=True)
class Field:
    target: str
    kind: str
    source: str | None


def fields(table: str) -> list[Field]:
    return [Field(*row) for row in TARGETS[table]]


def layout(register: str, record_type: str | None) -> list[str]:
    """The fields of a register's lines, in order: those of its targets, the record type behind the first five. Type 2 of the buildings is that of type 4 with edificialita."""
    if (register, record_type) == ("FAB", "2"):
        return [*layout("FAB", "4"), "edificialita"]
    out: list[str] = []
    for table, origin in ORIGINS.items():
        if origin == (register, record_type):
            out += [f.source for f in fields(table) if f.source and f.source not in out]
    return [*out[:5], "tipo_record", *out[5:]] if record_type else out


def optional(register: str, record_type: str | None) -> frozenset[str]:
    """The fields that records of this kind may lack."""
    return frozenset(layout(register, record_type)) & {*OPTIONAL, *OPTIONAL_OF[register]}


def fan_out(lines: DataFrame, register: str, record_type: str | None) -> DataFrame:
    """The named fields of one record type of a register's lines(register, value)."""
    parts = F.split("value", r"\|")
    rows = lines.where(F.col("register") == register)
    if record_type:
        rows = rows.where(strip(F.get(parts, F.lit(5))) == record_type)
    return rows.select(parts.alias("p")).select(*[F.get("p", F.lit(i)).alias(n) for i, n in enumerate(layout(register, record_type))])


def _cast(f: Field) -> Column:
    if f.source is None:
        return F.lit(None).cast("int" if f.kind == "nullint" else "string")
    c = F.col(f.source)
    if f.kind == "int":
        return safe_int(c)
    if f.kind == "trunc":
        return whole_part(c)
    if f.kind == "num":
        return float_text(c)
    if f.kind == "itext":
        return safe_int(c).cast("string")
    return c


def project(records: DataFrame, table: str) -> DataFrame:
    """The rows of a target table."""
    return records.select(*[_cast(f).alias(f.target) for f in fields(table)])


def only_persons(rows: DataFrame, table: str, natural: tuple[str, ...] = ("P",)) -> DataFrame:
    """Of subjects the natural or the legal persons, as the target table has; all rows of other tables. natural: codes of tipo_soggetto that mark natural persons."""
    if table == "ctfisica":
        return rows.where(F.col("tipo_sog").isin(*natural))
    if table == "ctnonfis":
        return rows.where(~F.coalesce(F.col("tipo_sog").isin(*natural), F.lit(False)))
    return rows


def target(lines: DataFrame, table: str, natural: tuple[str, ...] = ("P",)) -> DataFrame:
    """A target table from a register's lines. natural: codes of tipo_soggetto that mark natural persons; all others are legal persons."""
    return only_persons(project(fan_out(lines, *ORIGINS[table]), table), table, natural)
