"""Oracle SQL (DuckDB dialect) for the correctness gate.

Each query runs over the base tables only, so the ``raw`` fixture and the
``clean`` table are inlined as CTEs. The rules mirror occurlens.functions in
DuckDB syntax (``try_strptime`` for ``try_to_date``, ``regexp_matches`` for
``rlike``, the 'g' flag on ``regexp_replace``, sums cast back to BIGINT).
"""

from __future__ import annotations

from . import constants as C
from .sources.fixture import raw_blank_year_sql, raw_sql


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def tolerant_int(x: str) -> str:
    return (f"case when regexp_matches({x}, {_q(C.INTEGER_TEXT)})"
            f" then try_cast(trunc(try_cast(trim({x}) as double)) as integer) end")


def tolerant_double(x: str) -> str:
    return f"try_cast({x} as double)"


def parse_hour(x: str) -> str:
    return (f"case when regexp_matches({x}, {_q(C.HOUR_PATTERN)}) "
            f"then try_cast(split_part({x}, ':', 1) as integer) end")


_DUCK_DATE_FORMATS = {"yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S", "yyyy-MM-dd": "%Y-%m-%d",
                      "dd/MM/yyyy": "%d/%m/%Y"}


def parse_date(x: str) -> str:
    parts = [f"cast(try_strptime({x}, {_q(_DUCK_DATE_FORMATS[f])}) as date)" for f in C.DATE_FORMATS]
    return "coalesce(" + ", ".join(parts) + ")"


def clean_text(x: str) -> str:
    tokens = ", ".join(_q(t) for t in C.NULL_TOKENS)
    return f"case when upper(trim({x})) in ({tokens}) then null else trim({x}) end"


def normalize_bairro(x: str) -> str:
    out = f"upper(translate({x}, {_q(C.ACCENTS_FROM)}, {_q(C.ACCENTS_TO)}))"
    for pattern, expansion in C.ABBREVIATIONS:
        out = f"regexp_replace({out}, {_q(pattern)}, {_q(expansion)}, 'g')"
    return out


def crime_type(x: str) -> str:
    whens = " ".join(f"when contains(lower({x}), {_q(n)}) then {_q(l)}" for n, l in C.CRIME_RULES)
    return f"case {whens} else {_q(C.CRIME_OTHER)} end"


def brand(x: str) -> str:
    up = f"upper(trim({x}))"
    whens = " ".join(f"when regexp_matches({up}, {_q(p)}) then {_q(l)}" for p, l in C.BRAND_RULES)
    return f"case {whens} else {_q(C.BRAND_OTHER)} end"


def period(h: str) -> str:
    whens = " ".join(f"when {h} >= {lo} and {h} <= {hi} then {_q(l)}" for lo, hi, l in C.PERIODS)
    return f"case {whens} end"


def clean_select(src: str = "raw", date_mode: str = "compat", year: int | None = None) -> str:
    """SELECT producing the 16 clean columns from a raw relation."""
    ct = {c: clean_text(c) for c in C.TEXT_COLUMNS}
    hora = parse_hour("HORA_OCORRENCIA")
    cols = [
        f"{tolerant_int('ANO_BO')} as ano_bo",
        f"{tolerant_int('ANO')} as ano",
        f"{tolerant_int('MES')} as mes",
        f"{ct['NOME_MUNICIPIO_CIRC']} as municipio",
        f"{ct['CIDADE']} as cidade",
        f"{normalize_bairro(ct['BAIRRO'])} as bairro",
        f"{crime_type(ct['RUBRICA'])} as tipo_crime",
        f"{ct['RUBRICA']} as rubrica",
        f"{ct['DESCR_TIPOLOCAL']} as tipo_local",
        f"{brand(ct['MARCA_OBJETO'])} as marca",
        f"{hora} as hora",
        f"{period(hora)} as periodo",
        f"{tolerant_double('LATITUDE')} as latitude",
        f"{tolerant_double('LONGITUDE')} as longitude",
        f"{parse_date('DATA_OCORRENCIA_BO')} as data_ocorrencia",
        "ARQUIVO_ORIGEM as arquivo_origem",
    ]
    where = [date_filter(date_mode), f"upper({ct['FLAG_STATUS']}) = {_q(C.CONSUMMATED)}"]
    if year is not None:
        where.insert(0, f"{tolerant_int('ANO')} = {int(year)}")
    return "select " + ",\n  ".join(cols) + f"\nfrom {src}\nwhere " + " and ".join(where)


def date_filter(mode: str = "compat") -> str:
    if mode == "compat":
        return f"DATA_OCORRENCIA_BO >= {_q(C.MIN_DATE_STRING)}"
    return f"{parse_date('DATA_OCORRENCIA_BO')} >= date {_q(C.MIN_DATE_STRING)}"


def with_raw(body: str, extra_ctes: list[tuple[str, str]] | None = None, clean: bool = True,
             date_mode: str = "compat", year: int | None = None, extended: bool = False) -> str:
    ctes = [("raw", raw_sql(extended))]
    if clean:
        ctes.append(("clean", clean_select("raw", date_mode, year)))
    ctes += extra_ctes or []
    return "with " + ",\n".join(f"{n} as (\n{s}\n)" for n, s in ctes) + "\n" + body


def with_raw_blank_year(body: str, extra_ctes: list[tuple[str, str]] | None = None) -> str:
    return with_raw(body, [("raw0", raw_blank_year_sql())] + (extra_ctes or []), clean=False)


def top_sql(base: str, n: int) -> str:
    return (f"select * exclude (rk) from (select *, rank() over (partition by ano, tipo_crime "
            f"order by total desc) as rk from ({base})) where rk <= {n}")


# Uncut counts of the tables that are cut to a top N per year and type.
UNCUT_SQL = {
    C.KPI_MUNICIPALITY: ("select ano, municipio, tipo_crime, count(*) as total from clean"
                         " where municipio is not null group by all"),
    C.KPI_BAIRRO: (f"select ano, bairro, tipo_crime, count(*) as total from clean"
                   f" where municipio = {_q(C.CAPITAL)} and bairro is not null"
                   f" and upper(bairro) <> {_q(C.NOT_INFORMED)} group by all"),
    C.KPI_BRAND: (f"select ano, marca, tipo_crime, count(*) as total from clean"
                  f" where marca is not null and marca <> {_q(C.BRAND_OTHER)} group by all"),
}

# KPI bodies over a relation named ``clean``.
KPI_SQL = {
    C.KPI_ANNUAL: (
        "select ano, tipo_crime, total, round((total - lag(total) over w) / lag(total) over w * 100, 2)"
        " as variacao_yoy_pct from (select ano, tipo_crime, count(*) as total from clean group by all)"
        " window w as (partition by tipo_crime order by ano nulls first)"),
    C.KPI_MONTHLY: ("select ano, mes, tipo_crime, count(*) as total from clean"
                    " where mes is not null and mes between 1 and 12 group by all"),
    C.KPI_MUNICIPALITY: top_sql(UNCUT_SQL[C.KPI_MUNICIPALITY], C.TOP_MUNICIPALITIES),
    C.KPI_BAIRRO: top_sql(UNCUT_SQL[C.KPI_BAIRRO], C.TOP_BAIRROS),
    C.KPI_LOCATION: (f"select ano, tipo_local, tipo_crime, count(*) as total from clean"
                     f" where tipo_local is not null and upper(tipo_local) <> {_q(C.NOT_INFORMED)}"
                     f" group by all"),
    C.KPI_BRAND: top_sql(UNCUT_SQL[C.KPI_BRAND], C.TOP_BRANDS),
    C.KPI_HOUR: (
        "select p.ano, p.tipo_crime, h.hora, cast(coalesce(c.total, 0) as bigint) as total"
        " from (select distinct ano, tipo_crime from clean) p"
        " cross join (select cast(range as integer) as hora from range(24)) h"
        " left join (select ano, tipo_crime, hora, count(*) as total from clean"
        "            where hora is not null and hora between 0 and 23 group by all) c"
        " on p.ano = c.ano and p.tipo_crime = c.tipo_crime and h.hora = c.hora"),
    C.KPI_PERIOD: ("select ano, periodo, tipo_crime, count(*) as total from clean"
                   " where periodo is not null group by all"),
}
