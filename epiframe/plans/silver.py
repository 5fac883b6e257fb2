"""Raw records to the nine normalised tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window, functions as F

from epiframe.contracts import DOMAIN_ROWS, LOAD_ORDER, SILVER
from epiframe.functions.age import age_years_double
from epiframe.functions.clean import (
    is_marked, label, not_sentinel, prefix6, to_date, to_int, week_of,
)
from epiframe.operators.ids import dense_id
from epiframe.operators.lookup import BROADCAST_ROWS, resolve, resolve_large, resolve_unique, unique_lookup
from epiframe.session import cut_counted
from epiframe.sources.bronze import uf_siglas


@dataclass(frozen=True)
class Municipality:
    """Foreign key found through the six-character prefix."""

    raw: str

    def keys(self) -> list[Column]:
        return [prefix6(F.trim(self.raw))]


@dataclass(frozen=True)
class Known:
    """The code itself where a bounded dimension has it, else NULL."""

    raw: str
    dim: str
    key: str

    def keys(self) -> list[Column]:
        return [_smallint(self.raw)]


@dataclass(frozen=True)
class Region:
    """Surrogate key of (region, unit)."""

    region: str
    uf: str

    def keys(self) -> list[Column]:
        return [_smallint(self.region), _smallint(self.uf)]


@dataclass(frozen=True)
class Unit:
    """The unit code where the unit table, which may be large, has it, else NULL."""

    raw: str

    def keys(self) -> list[Column]:
        return [to_int(F.col(self.raw), "int")]


def _smallint(name: str) -> Column:
    return to_int(F.col(name), "smallint")


# How each column comes from the raw record. Only the columns asked for are computed, so a
# question over three columns does not pay for six key lookups.
PATIENT = {
    "paciente_id": lambda: F.col("row_id"),
    "idade_codificada": lambda: _smallint("idade_codificada"),
    "sexo": lambda: label("sexo"),
    "idade_gestacional": lambda: label("idade_gestacional"),
    "raca_cor": lambda: label("raca_cor"),
    "escolaridade": lambda: label("escolaridade"),
    "municipio_id": Municipality("municipio_residencia"),
    "regional_residencia": Region("regional_residencia", "uf_residencia"),
    "pais_id": Known("pais_residencia", "paises", "pais_id"),
    "ocupacao": lambda: F.lit(None).cast("string"),
}
CASE = {
    "notificacao_id": lambda: F.col("row_id"),
    "paciente_id": lambda: F.col("row_id"),
    "data_notificacao": lambda: to_date(F.col("data_notificacao")),
    "semana_notificacao": lambda: week_of(F.col("semana_notificacao")),
    "unidade_id": Unit("codigo_unidade"),
    "regional_notificacao": Region("codigo_regional", "uf_notificacao"),
    "data_primeiros_sintomas": lambda: to_date(F.col("data_primeiros_sintomas")),
    "semana_primeiros_sintomas": lambda: week_of(F.col("semana_primeiros_sintomas")),
    "data_investigacao": lambda: to_date(F.col("data_investigacao")),
    "classificacao_final": lambda: label("classificacao_final"),
    "criterio_confirmacao": lambda: label("criterio_confirmacao"),
    "autoctonia": lambda: label("autoctonia"),
    "uf_provavel_infeccao": Known("uf_provavel_infeccao", "ufs", "uf_id"),
    "municipio_provavel_infeccao": Municipality("municipio_provavel_infeccao"),
    "pais_provavel_infeccao": Known("pais_provavel_infeccao", "paises", "pais_id"),
    "doenca_trabalho": lambda: label("doenca_trabalho"),
    "evolucao_caso": lambda: label("evolucao_caso"),
    "nduplic": lambda: is_marked(F.col("notificacao_duplicada")),
    "fluxo_retorno": lambda: _smallint("fluxo_retorno"),
    "fluxo_recebido": lambda: _smallint("fluxo_recebido"),
}


DIMENSIONS = ("ufs", "municipios", "paises", "regionais_saude", "unidades_notificadoras")


class Silver:
    """Lazy builders of the silver tables over one raw frame and one gazetteer.

    A table that looks keys up derives the dimensions it needs along with itself, unless ``settle`` or a load
    has written them before: then it is one scan of the raw frame and joins with small stored tables.
    """

    def __init__(self, bronze: DataFrame, gazetteer: DataFrame):
        self.bronze = bronze
        self.gazetteer = gazetteer
        self.spark = bronze.sparkSession
        # Row counts of dimensions: the most that their keys allow, exact once they are written.
        self.rows: dict[str, int] = dict(DOMAIN_ROWS)

    def settle(self) -> Silver:
        """Write the dimensions to the shared folder, from one scan of the raw frame and one of the gazetteer."""
        self.__dict__["codes"], _ = cut_counted(self.codes)
        self.gazetteer, _ = cut_counted(self.gazetteer.distinct())
        for name in DIMENSIONS:
            self.replace(name, *cut_counted(self.table(name)))
        return self

    # --- dimensions ---------------------------------------------------------------
    @cached_property
    def codes(self) -> DataFrame:
        """Distinct raw codes of all dimensions, from one scan: kind, and up to three texts."""
        groups = (
            ("pais", "pais_residencia"), ("pais", "pais_provavel_infeccao"),
            ("regional", "codigo_regional", "uf_notificacao"), ("regional", "regional_residencia", "uf_residencia"),
            ("unidade", "codigo_unidade", "municipio_notificacao", "tipo_unidade"),
        )
        none = F.lit(None).cast("string")
        texts = [(F.lit(kind), *map(F.col, columns), *[none] * (3 - len(columns))) for kind, *columns in groups]
        every = F.array(*[F.struct(*[c.alias(n) for c, n in zip(group, ("kind", "a", "b", "c"), strict=True)]) for group in texts])
        return self.bronze.select(F.explode(every).alias("g")).select("g.*").distinct()

    @cached_property
    def ufs(self) -> DataFrame:
        codes = self.gazetteer.select(F.col("uf_code").cast("smallint").alias("uf_id"), F.col("uf_nome").alias("nome"))
        return codes.distinct().join(F.broadcast(uf_siglas(self.spark)), "uf_id").select("uf_id", "sigla", "nome")

    @cached_property
    def municipios(self) -> DataFrame:
        return self.gazetteer.select(
            F.col("municipio_id").cast("int").alias("municipio_id"),
            F.col("municipio_nome").alias("nome"),
            F.col("uf_code").cast("smallint").alias("uf_id"),
        ).distinct()

    @cached_property
    def municipality_lookup(self) -> DataFrame:
        return unique_lookup(self.municipios, prefix6(F.col("municipio_id").cast("string")), "municipio_id")

    @cached_property
    def paises(self) -> DataFrame:
        raw = self.codes.filter("kind = 'pais'").select(F.col("a").alias("code"))
        return (
            raw.filter(not_sentinel(F.col("code"), "0"))
            .select(
                to_int(F.col("code"), "smallint").alias("pais_id"),
                F.when(F.col("code") == "1", "Brasil").otherwise("Desconhecido").alias("nome"),
            )
            .filter(F.col("pais_id").isNotNull())
            .distinct()
        )

    @cached_property
    def regionais_saude(self) -> DataFrame:
        raw = self.codes.filter("kind = 'regional'").select(F.col("a").alias("region"), F.col("b").alias("uf"))
        pairs = (
            raw.filter(not_sentinel(F.col("region")) & not_sentinel(F.col("uf")))
            .select(
                to_int(F.col("region"), "smallint").alias("regional_id"),
                to_int(F.col("uf"), "smallint").alias("uf_id"),
            )
            .filter(F.col("regional_id").isNotNull())
            .distinct()
            .join(F.broadcast(self.ufs.select("uf_id")), "uf_id", "left_semi")
        )
        # At most 65,536 regions in 27 units: numbering them in one task is safe.
        number = F.row_number().over(Window.orderBy("uf_id", "regional_id"))
        return pairs.select(number.cast("long").alias("regional_saude_id"), "regional_id", "uf_id")

    @cached_property
    def unidades_notificadoras(self) -> DataFrame:
        placed = self.codes.filter("kind = 'unidade'").filter(not_sentinel(F.col("a"), "0") & not_sentinel(F.col("b"))).select(
            to_int(F.col("a"), "int").alias("unidade_id"),
            to_int(F.col("c"), "smallint").alias("tipo"),
            prefix6(F.trim("b")).alias("prefix"),
        )
        found = resolve_unique(placed, "municipio_id", F.col("prefix"), self.municipality_lookup, self.rows["municipios"]).filter(
            F.col("unidade_id").isNotNull() & F.col("municipio_id").isNotNull()
        )
        # Lowest municipality wins, then lowest type: a map-side minimum, no window.
        return (
            found.groupBy("unidade_id")
            .agg(F.min(F.struct("municipio_id", "tipo")).alias("w"))
            .select("unidade_id", F.lit(None).cast("string").alias("nome"), "w.tipo", "w.municipio_id")
        )

    # --- record-level tables --------------------------------------------------------
    def _record(self, spec: dict, columns: tuple[str, ...]) -> DataFrame:
        """Project the raw frame onto ``columns`` of ``spec``, joining only what they need."""
        names = columns or tuple(spec)
        keys = {n: spec[n].keys() for n in names if not callable(spec[n])}
        # Parse first: the joins then carry typed values and short keys, not the raw text.
        df = self.bronze.select(
            F.col("row_id").alias("__row"),
            *[spec[n]().alias(n) for n in names if n not in keys],
            *[c.alias(f"__{n}_{i}") for n, parts in keys.items() for i, c in enumerate(parts)],
        )
        for name, parts in keys.items():
            df = self._join(df, spec[name], name, [F.col(f"__{name}_{i}") for i in range(len(parts))])
        return df.select(*names)

    def _join(self, df: DataFrame, rule, out: str, key: list[Column]) -> DataFrame:
        match rule:
            case Municipality():
                return resolve_unique(df, out, key[0], self.municipality_lookup, self.rows["municipios"])
            case Known(_, dim, dim_key):
                ids = getattr(self, dim).select(dim_key).distinct()
                return resolve(df, out, {dim_key: key[0]}, ids, dim_key, self.rows[dim])
            case Region():
                return resolve(
                    df, out, {"regional_id": key[0], "uf_id": key[1]}, self.regionais_saude, "regional_saude_id",
                    self.rows["regionais_saude"],
                )
            case Unit():
                units = self.unidades_notificadoras
                if self.rows.get("unidades_notificadoras", BROADCAST_ROWS + 1) <= BROADCAST_ROWS:
                    return resolve(df, out, {"unidade_id": key[0]}, units, "unidade_id", self.rows["unidades_notificadoras"])
                return resolve_large(df, out, key[0], units, "unidade_id")
        raise TypeError(rule)

    def pacientes(self, *columns: str) -> DataFrame:
        return self._record(PATIENT, columns)

    def notificacoes_casos(self, *columns: str) -> DataFrame:
        return self._record(CASE, columns)

    def base(self, *columns: str) -> DataFrame:
        """Case and patient columns of each record, decoded age, unit abbreviation and years.

        A record is one case and one patient, so this is a projection of the raw frame; no
        patient-case join is needed.
        """
        spec = {**PATIENT, **CASE}
        derived = {
            "idade_anos": (("idade_codificada",), age_years_double(F.col("idade_codificada"))),
            "ano": (("data_notificacao",), F.year("data_notificacao")),
            "ano_sintomas": (("data_primeiros_sintomas",), F.year("data_primeiros_sintomas")),
            "sigla": (("uf_provavel_infeccao",), None),
            "nome": (("uf_provavel_infeccao",), None),
        }
        wanted = columns or (*CASE, *[c for c in PATIENT if c != "paciente_id"], *derived)
        plain = [c for c in wanted if c in spec]
        for name in wanted:
            if name in derived:
                plain += [c for c in derived[name][0] if c not in plain]
        df = self._record(spec, tuple(plain))
        for name in wanted:
            if name in derived and derived[name][1] is not None:
                df = df.withColumn(name, derived[name][1])
        if {"sigla", "nome"} & set(wanted):
            names = self.ufs.select(F.col("uf_id").alias("__uf"), "sigla", "nome")
            df = df.join(F.broadcast(names), F.col("uf_provavel_infeccao") == F.col("__uf"), "left")
        return df.select(*wanted)

    def _dated(self, raw: str, id_name: str) -> DataFrame:
        rows = self.bronze.filter(not_sentinel(F.col(raw))).select(
            F.col("row_id").alias("notificacao_id"), to_date(F.col(raw)).alias(raw)
        )
        return dense_id(rows, "notificacao_id", id_name)

    @cached_property
    def obitos(self) -> DataFrame:
        return self._dated("data_obito", "obito_id")

    @cached_property
    def casos_encerrados(self) -> DataFrame:
        return self._dated("data_encerramento", "caso_encerrado_id")

    def table(self, name: str) -> DataFrame:
        """One table with the contract's column order and types."""
        member = getattr(self, name)
        df = member() if callable(member) else member
        return df.select(*[F.col(f.name).cast(f.type) for f in SILVER[name].fields])

    def tables(self) -> dict[str, DataFrame]:
        """All nine tables, parents first."""
        return {name: self.table(name) for name in LOAD_ORDER}

    def replace(self, name: str, written: DataFrame, rows: int) -> None:
        """Let later tables look up a dimension as written, instead of deriving it again."""
        if isinstance(getattr(type(self), name), cached_property):
            self.__dict__[name] = written
            self.rows[name] = rows
