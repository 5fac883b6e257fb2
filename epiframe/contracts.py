"""Fixed values and table contracts of the surveillance data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: raw column name -> domain name of the case file --------------------
CASE_COLUMNS = {
    "arquivo_origem": "arquivo_origem",
    "ano_arquivo": "ano_arquivo",
    "DT_NOTIFIC": "data_notificacao",
    "SEM_NOT": "semana_notificacao",
    "SG_UF_NOT": "uf_notificacao",
    "ID_MUNICIP": "municipio_notificacao",
    "ID_REGIONA": "codigo_regional",
    "DT_SIN_PRI": "data_primeiros_sintomas",
    "SEM_PRI": "semana_primeiros_sintomas",
    "NU_IDADE_N": "idade_codificada",
    "CS_SEXO": "sexo",
    "CS_GESTANT": "idade_gestacional",
    "CS_RACA": "raca_cor",
    "CS_ESCOL_N": "escolaridade",
    "SG_UF": "uf_residencia",
    "ID_MN_RESI": "municipio_residencia",
    "ID_RG_RESI": "regional_residencia",
    "ID_PAIS": "pais_residencia",
    "NDUPLIC_N": "notificacao_duplicada",
    "DT_INVEST": "data_investigacao",
    "CLASSI_FIN": "classificacao_final",
    "CRITERIO": "criterio_confirmacao",
    "TPAUTOCTO": "autoctonia",
    "COUFINF": "uf_provavel_infeccao",
    "COPAISINF": "pais_provavel_infeccao",
    "COMUNINF": "municipio_provavel_infeccao",
    "DOENCA_TRA": "doenca_trabalho",
    "EVOLUCAO": "evolucao_caso",
    "DT_OBITO": "data_obito",
    "DT_ENCERRA": "data_encerramento",
    "CS_FLXRET": "fluxo_retorno",
    "FLXRECEBI": "fluxo_recebido",
    "TPUNINOT": "tipo_unidade",
    "ID_UNIDADE": "codigo_unidade",
    "ANO_NASC": "ano_nascimento",
    "DT_DIGITA": "data_digitacao",
}

# --- Fixed values: federative unit code -> abbreviation -------------------------------
UF_SIGLAS = {
    11: "RO", 12: "AC", 13: "AM", 14: "RR", 15: "PA", 16: "AP", 17: "TO",
    21: "MA", 22: "PI", 23: "CE", 24: "RN", 25: "PB", 26: "PE", 27: "AL", 28: "SE", 29: "BA",
    31: "MG", 32: "ES", 33: "RJ", 35: "SP",
    41: "PR", 42: "SC", 43: "RS",
    50: "MS", 51: "MT", 52: "GO", 53: "DF",
}

# --- Fixed values: coded answer -> label ----------------------------------------------
LABELS = {
    "sexo": {"M": "Masculino", "F": "Feminino", "I": "Ignorado"},
    "idade_gestacional": {
        "1": "1º trimestre",
        "2": "2º trimestre",
        "3": "3º trimestre",
        "4": "Idade gestacional ignorada",
        "5": "Não",
        "6": "Não se aplica",
        "9": "Ignorado",
    },
    "raca_cor": {
        "1": "Branca", "2": "Preta", "3": "Amarela", "4": "Parda", "5": "Indígena", "9": "Ignorado",
    },
    "escolaridade": {
        "0": "Analfabeto",
        "1": "1ª a 4ª série incompleta do EF",
        "2": "4ª série completa do EF",
        "3": "5ª a 8ª série incompleta do EF",
        "4": "Ensino Fundamental completo",
        "5": "Ensino Médio incompleto",
        "6": "Ensino Médio completo",
        "7": "Educação superior incompleta",
        "8": "Educação superior completa",
        "9": "Ignorado",
        "10": "Não se aplica",
    },
    "classificacao_final": {
        "0": "Descartado", "1": "Confirmado", "2": "Em investigação", "8": "Inconclusivo",
    },
    "criterio_confirmacao": {
        "0": "Em investigação", "1": "Laboratorial", "2": "Clínico-epidemiológico",
    },
    "autoctonia": {"1": "Sim", "2": "Não", "3": "Indeterminado"},
    "doenca_trabalho": {"1": "Sim", "2": "Não", "9": "Ignorado"},
    "evolucao_caso": {
        "0": "Em investigação",
        "1": "Cura",
        "2": "Óbito pelo agravo",
        "3": "Óbito por outra causa",
        "9": "Ignorado",
    },
}

# Label given to an unknown or missing code; a field that is absent here stays NULL.
LABEL_DEFAULTS = {
    "sexo": "Ignorado",
    "idade_gestacional": "Ignorado",
    "raca_cor": "Ignorado",
    "escolaridade": "Ignorado",
    "classificacao_final": "Em investigação",
    "autoctonia": "Indeterminado",
    "doenca_trabalho": "Ignorado",
    "evolucao_caso": "Ignorado",
}

CONFIRMED = "Confirmado"
UNDER_INVESTIGATION = "Em investigação"
INCONCLUSIVE = "Inconclusivo"
DEATH_BY_DISEASE = "Óbito pelo agravo"
DEATH_LABELS = ("Óbito pelo agravo", "Óbito por outra causa")
CLASSIFICATIONS = ("Confirmado", "Descartado", "Em investigação", "Inconclusivo")
TRIMESTERS = ("1º trimestre", "2º trimestre", "3º trimestre")
SEXES = ("Masculino", "Feminino")

# Study window of the statistics, both ends included.
# --- Fixed values: study window, age bands, features, gold tables and the contracts below must be as they are ---
STUDY_START, STUDY_END = "2018-01-01", "2026-06-10"

# Age bands: exclusive upper bound in years -> name; everything else is the last band.
AGE_BANDS = (
    (5, "0-4"), (10, "5-9"), (15, "10-14"), (20, "15-19"), (30, "20-29"), (40, "30-39"),
    (50, "40-49"), (60, "50-59"), (70, "60-69"), (80, "70-79"),
)
LAST_BAND = "80+"
BAND_ORDER = tuple(name for _, name in AGE_BANDS) + (LAST_BAND,)

# Features of the municipality clustering, in order.
FEATURES = (
    "total_confirmados", "taxa_confirmacao", "idade_media",
    "pct_gestantes", "pct_obito", "pct_autoctone",
)
MIN_CONFIRMED = 10
HORIZON_WEEKS = 12
SEASON_WEEKS = 52


# --- Table contracts ------------------------------------------------------------------
@dataclass(frozen=True)
class Field:
    name: str
    type: T.DataType
    required: bool = False
    width: int | None = None
    default: object = None


@dataclass(frozen=True)
class Ref:
    """A foreign key from ``column`` to the key of ``parent``."""

    column: str
    parent: str


@dataclass(frozen=True)
class Table:
    name: str
    key: str
    fields: tuple[Field, ...]
    uniques: tuple[tuple[str, ...], ...] = ()
    refs: tuple[Ref, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type, True) for f in self.fields])

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    @property
    def widths(self) -> dict[str, int]:
        return {f.name: f.width for f in self.fields if f.width}

    @property
    def defaults(self) -> dict[str, object]:
        return {f.name: f.default for f in self.fields if f.default is not None}


_S, _I, _L, _D, _B, _X = (
    T.ShortType(), T.IntegerType(), T.LongType(), T.DateType(), T.BooleanType(), T.StringType(),
)

SILVER = {
    t.name: t
    for t in (
        Table(
            "ufs", "uf_id",
            (Field("uf_id", _S, True), Field("sigla", _X, True, 2), Field("nome", _X, True, 50)),
            uniques=(("sigla",),),
        ),
        Table(
            "paises", "pais_id",
            (Field("pais_id", _S, True), Field("nome", _X, True, 50)),
        ),
        Table(
            "municipios", "municipio_id",
            (
                Field("municipio_id", _I, True),
                Field("nome", _X, True, 100),
                Field("uf_id", _S, True),
            ),
            refs=(Ref("uf_id", "ufs"),),
        ),
        Table(
            "regionais_saude", "regional_saude_id",
            (
                Field("regional_saude_id", _L, True),
                Field("regional_id", _S, True),
                Field("uf_id", _S, True),
            ),
            uniques=(("regional_id", "uf_id"),),
            refs=(Ref("uf_id", "ufs"),),
        ),
        Table(
            "unidades_notificadoras", "unidade_id",
            (
                Field("unidade_id", _I, True),
                Field("nome", _X, False, 50),
                Field("tipo", _S),
                Field("municipio_id", _I, True),
            ),
            refs=(Ref("municipio_id", "municipios"),),
        ),
        Table(
            "pacientes", "paciente_id",
            (
                Field("paciente_id", _L, True),
                Field("idade_codificada", _S, True),
                Field("sexo", _X, True, 9, "Ignorado"),
                Field("idade_gestacional", _X, True, 30, "Ignorado"),
                Field("raca_cor", _X, True, 8, "Ignorado"),
                Field("escolaridade", _X, True, 50, "Ignorado"),
                Field("municipio_id", _I),
                Field("regional_residencia", _L),
                Field("pais_id", _S),
                Field("ocupacao", _X, False, 30),
            ),
            refs=(
                Ref("municipio_id", "municipios"),
                Ref("regional_residencia", "regionais_saude"),
                Ref("pais_id", "paises"),
            ),
        ),
        Table(
            "notificacoes_casos", "notificacao_id",
            (
                Field("notificacao_id", _L, True),
                Field("paciente_id", _L, True),
                Field("data_notificacao", _D, True),
                Field("semana_notificacao", _S, True),
                Field("unidade_id", _I),
                Field("regional_notificacao", _L),
                Field("data_primeiros_sintomas", _D, True),
                Field("semana_primeiros_sintomas", _S, True),
                Field("data_investigacao", _D),
                Field("classificacao_final", _X, True, 20),
                Field("criterio_confirmacao", _X, False, 30),
                Field("autoctonia", _X, True, 20, "Indeterminado"),
                Field("uf_provavel_infeccao", _S),
                Field("municipio_provavel_infeccao", _I),
                Field("pais_provavel_infeccao", _S),
                Field("doenca_trabalho", _X, True, 10, "Ignorado"),
                Field("evolucao_caso", _X, True, 30, "Ignorado"),
                Field("nduplic", _B, True, None, False),
                Field("fluxo_retorno", _S),
                Field("fluxo_recebido", _S),
            ),
            refs=(
                Ref("paciente_id", "pacientes"),
                Ref("unidade_id", "unidades_notificadoras"),
                Ref("regional_notificacao", "regionais_saude"),
                Ref("uf_provavel_infeccao", "ufs"),
                Ref("municipio_provavel_infeccao", "municipios"),
                Ref("pais_provavel_infeccao", "paises"),
            ),
        ),
        Table(
            "obitos", "obito_id",
            (
                Field("obito_id", _L, True),
                Field("notificacao_id", _L, True),
                Field("data_obito", _D, True),
            ),
            refs=(Ref("notificacao_id", "notificacoes_casos"),),
        ),
        Table(
            "casos_encerrados", "caso_encerrado_id",
            (
                Field("caso_encerrado_id", _L, True),
                Field("notificacao_id", _L, True),
                Field("data_encerramento", _D, True),
            ),
            refs=(Ref("notificacao_id", "notificacoes_casos"),),
        ),
    )
}

# Parents come before children.
LOAD_ORDER = tuple(SILVER)

# Most rows a lookup in a dimension can have, by the domain of its key: 27 unit codes; SMALLINT
# country codes; six-character prefixes of whole numbers; SMALLINT region codes within 27 units.
DOMAIN_ROWS = {"ufs": 27, "paises": 1 << 16, "municipios": 1_100_000, "regionais_saude": 27 << 16}

# Dimensions that such a bound lets be broadcast at any data volume.
BOUNDED_TABLES = frozenset(DOMAIN_ROWS)

GOLD = (
    "sazonalidade_semanal",
    "perfil_sazonal_semana_epi",
    "tendencia_casos_uf",
    "previsao_casos_semanal",
    "clusters_municipios",
)
