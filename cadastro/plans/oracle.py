"""DuckDB SQL for every query in :mod:`cadastro.plans.catalog` (the correctness oracle).

The raw-layout derivations of the test data are shared text (:mod:`cadastro.plans.fixtures`); everything
else is stated here on its own, in DuckDB's functions and in literal lists, and imports nothing from the
code under test:

* ASCII fold on the test text: ``strip_accents`` plus ``ß -> ss`` (the only letters present);
* ``initcap`` (words split on blanks only): split on ' ', upper-case the first letter of each word;
* lenient int: a regex guard, drop the fraction, ``TRY_CAST``;
* lenient dates: ``try_strptime``.
"""

from __future__ import annotations

from . import fixtures as fx

# Fixed values of the registry: labels, file ids, layouts and header names, as published.
AGE_BANDS = {
    0: "Nao se aplica", 1: "0 a 12 anos", 2: "13 a 20 anos", 3: "21 a 30 anos", 4: "31 a 40 anos",
    5: "41 a 50 anos", 6: "51 a 60 anos", 7: "61 a 70 anos", 8: "71 a 80 anos", 9: "Mais de 80 anos",
}
COMPANY_SIZES = {
    1: "Nao Informado", 2: "Micro Empresa", 3: "Empresa de Pequeno Porte", 5: "Demais",
}
HEAD_OFFICE = {
    1: "Matriz", 2: "Filial",
}
PARTNER_KINDS = {
    1: "PJ", 2: "PF", 3: "Estrangeiro",
}
LOOKUP_IDS = {
    "CNAE": "cnae", "MUNIC": "mun", "NATJU": "natju", "PAIS": "pais", "QUALS": "qual_socio", "MOTI": "motivo",
}
ESTAB_COLUMNS = (
    "cnpj", "cnpj_ordem", "cnpj_dv", "id_matriz", "nome_fantasia", "situacao_cadastral",
    "data_situacao_cadastral", "motivo_situacao_cadastral", "nome_cidade_ext", "cod_pais",
    "data_inicio_atividades", "cnae_primario", "cnae_secundario", "tipo_logradouro", "logradouro", "numero",
    "complemento", "bairro", "cep", "uf", "cod_mun", "ddd_1", "telefone_1", "ddd_2", "telefone_2", "ddd_fax",
    "fax", "correio_eletronico", "situacao_especial", "data_situacao_especial",
)
MOV_HEADERS = {
    "competência": "data", "região": "cod_regiao", "uf": "cod_uf", "município": "cod_municipio",
    "seção": "cod_secao", "subclasse": "cod_subclasse", "saldomovimentação": "saldo_movimentacao",
    "cbo2002ocupação": "cod_cbo_ocupacao", "categoria": "cod_categoria",
    "graudeinstrução": "cod_grau_instrucao", "idade": "idade", "horascontratuais": "horas_contrato",
    "raçacor": "cod_raca", "sexo": "cod_sexo", "tipoempregador": "cod_tipo_empregador",
    "tipoestabelecimento": "cod_tipo_estab", "tipomovimentação": "cod_tipo_mov",
    "tipodedeficiência": "cod_tipo_deficiencia", "indtrabintermitente": "cod_ind_trab_intermitente",
    "indtrabparcial": "cod_ind_trab_parcial", "salário": "salario", "tamestabjan": "cod_tamanho_estab",
    "indicadoraprendiz": "cod_ind_aprendiz", "fonte": "cod_fonte",
}
ESTAB_FLOW_HEADERS = {
    "competência": "data", "região": "cod_regiao", "uf": "cod_uf", "município": "cod_municipio",
    "seção": "cod_secao", "subclasse": "cod_subclasse", "admitidos": "admitidos", "desligados": "desligados",
    "saldomovimentação": "saldo_movimentacao", "tipoempregador": "cod_tipo_empregador",
    "tipoestabelecimento": "cod_tipo_estab", "tamestabjan": "cod_tamanho_estab", "fonte_desl": "cod_fonte",
}
HEADERS = {"mov": MOV_HEADERS, "estab": ESTAB_FLOW_HEADERS}
INTEGERS = {"mov": ("horas_contrato", "idade", "saldo_movimentacao"),
            "estab": ("admitidos", "desligados", "saldo_movimentacao")}
MOV_SHEETS = {
    "região": "regiao.csv", "uf": "uf.csv", "município": "municipio.csv", "seção": "secao.csv",
    "subclasse": "subclasse.csv", "fonte_desl": "fonte.csv", "categoria": "categoria.csv",
    "cbo2002ocupação": "cbo_ocupacao.csv", "graudeinstrução": "grau_instrucao.csv", "sexo": "sexo.csv",
    "tipoempregador": "tipo_empregador.csv", "tipoestabelecimento": "tipo_estab.csv",
    "tipomovimentação": "tipo_mov.csv", "indtrabparcial": "ind_trab_parcial.csv",
    "indtrabintermitente": "ind_trab_intermitente.csv", "tipodedeficiência": "tipo_deficiencia.csv",
    "raçacor": "raca.csv", "indicadoraprendiz": "ind_aprendiz.csv", "tamestabjan": "tamanho_estab.csv",
}
UNKNOWN_MUNICIPALITY = "Nao Identificado"
# ASCII spelling of the signs U+00A0 to U+00BF in order, and of the letters without accents.
LATIN1_SIGNS = [
    " ", "!", "C/", "PS", "$?", "Y=", "|", "SS", '"', "(c)", "a", "<<", "!", "", "(r)", "-",
    "deg", "+-", "2", "3", "'", "u", "P", "*", ",", "1", "o", ">>", " 1/4 ", " 1/2 ", " 3/4 ", "?",
]
LATIN1_LETTERS = {"Æ": "AE", "Ð": "D", "×": "x", "Ø": "O", "Þ": "Th", "ß": "ss", "æ": "ae", "ð": "d", "÷": "/", "ø": "o", "þ": "th"}

D = fx.DUCK


def fold(x: str) -> str:
    return f"replace(strip_accents({x}), 'ß', 'ss')"


def initcap(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def clean(x: str) -> str:
    return initcap(f"trim({fold(x)})")


def to_int(x: str) -> str:
    return (f"TRY_CAST(CASE WHEN regexp_matches(trim({x}), '^[+-]?[0-9]+(\\.[0-9]*)?$') "
            f"THEN regexp_replace(trim({x}), '\\.[0-9]*$', '') END AS INTEGER)")


def to_date(x: str, fmt: str = "%Y%m%d") -> str:
    """Spark's ``yyyyMMdd`` / ``yyyyMM`` parse needs every digit; DuckDB's ``%d``/``%m`` also take one."""
    digits = {"%Y%m%d": 8, "%Y%m": 6}[fmt]
    return (f"CAST(CASE WHEN regexp_matches({x}, '^[0-9]{{{digits}}}$') THEN try_strptime({x}, '{fmt}') END AS DATE)")


def label(x: str, mapping) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in mapping.items())
    return f"CASE {x} {whens} END"


def select(pairs) -> str:
    return ", ".join(f'{e} AS "{c}"' for c, e in pairs)


def q(name: str) -> str:
    return f'"{name}"'


def lookup_cte(cte: str, source: str, name: str) -> str:
    maker = {"nation": fx.lookup_nation, "region": fx.lookup_region, "part": fx.lookup_part,
             "supplier": fx.lookup_supplier, "customer": fx.lookup_customer}[source]
    (code, code_e), (nome, nome_e) = maker(name)
    return f"{cte} AS (SELECT {to_int(code_e)} AS {code}, {clean(nome_e)} AS {nome} FROM {source})"


# ---- scalar functions ---------------------------------------------------------------------------------

SQL: dict[str, str] = {}

SQL["ascii_fold"] = f"SELECT doc_id, {fold('text')} AS folded FROM documents"


def latin1_fold(x: str) -> str:
    for k, ascii_text in enumerate(LATIN1_SIGNS):
        x = f"replace({x}, chr({160 + k}), '{ascii_text.replace(chr(39), chr(39) * 2)}')"
    for letter, ascii_text in LATIN1_LETTERS.items():
        x = f"replace({x}, '{letter}', '{ascii_text}')"
    return f"strip_accents({x})"


SQL["ascii_fold_latin1"] = f"""
SELECT p_partkey, {latin1_fold("p_name || chr(CAST(160 + p_partkey % 96 AS INTEGER)) || 'x'")} AS folded FROM part"""
SQL["clean_text"] = f"SELECT doc_id, {clean('text')} AS cleaned FROM documents"

SQL["lenient_int"] = f"""
SELECT c_custkey, raw, {to_int('raw')} AS value FROM (
  SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 11 = 0 THEN 'x'
    WHEN c_custkey % 13 = 0 THEN replace(CAST(c_acctbal AS STRING), '.', ',')
    WHEN c_custkey % 17 = 0 THEN ' ' || CAST(c_nationkey AS STRING) || ' '
    ELSE CAST(c_acctbal AS STRING) END AS raw
  FROM customer)"""

SQL["lenient_double"] = """
SELECT l_orderkey, l_linenumber, raw, TRY_CAST(raw AS DOUBLE) AS value FROM (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN '' WHEN l_orderkey % 11 = 0 THEN 'x'
    WHEN l_orderkey % 13 = 0 THEN replace(CAST(l_extendedprice AS STRING), '.', ',')
    ELSE CAST(l_extendedprice AS STRING) END AS raw
  FROM lineitem)"""

SQL["decimal_comma"] = """
SELECT c_custkey, raw, TRY_CAST(replace(raw, ',', '.') AS FLOAT) AS value FROM (
  SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN ''
    WHEN c_custkey % 9 = 0 THEN '1.' || replace(CAST(c_acctbal AS STRING), '.', ',')
    ELSE replace(CAST(c_acctbal AS STRING), '.', ',') END AS raw
  FROM customer)"""

_YMD_O = D.ymd("o_orderdate")
SQL["lenient_date"] = f"""
SELECT o_orderkey, raw, {to_date('raw')} AS value FROM (
  SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '00000000' WHEN o_orderkey % 11 = 0 THEN '20210230'
    WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderkey % 17 = 0 THEN substr({_YMD_O}, 1, 7) ELSE {_YMD_O} END AS raw
  FROM orders)"""

SQL["year_month"] = f"""
SELECT l_orderkey, l_linenumber, raw, {to_date('raw', '%Y%m')} AS value FROM (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 7 = 0 THEN {D.ymd('l_shipdate')}
    WHEN l_orderkey % 11 = 0 THEN '' ELSE {D.ym('l_shipdate')} END AS raw
  FROM lineitem)"""

SQL["zero_pad"] = """
SELECT c_custkey, raw, lpad(raw, 8, '0') AS padded, lpad(CAST(c_nationkey AS STRING), 7, '0') AS activity FROM (
  SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 5 = 0 THEN CAST(c_custkey * 1000003 AS STRING)
    WHEN c_custkey % 7 = 0 THEN '' ELSE CAST(c_custkey AS STRING) END AS raw
  FROM customer)"""

SQL["compose_id"] = """
SELECT l_orderkey, l_linenumber, l_suppkey,
  lpad(CAST(l_orderkey AS STRING), 8, '0')
  || CASE WHEN l_linenumber <> 7 THEN lpad(CAST(l_linenumber AS STRING), 4, '0') END
  || lpad(CAST(l_suppkey % 100 AS STRING), 2, '0') AS full_id
FROM lineitem"""

SQL["code_label"] = f"""
SELECT o_orderkey, {label('o_orderkey % 12', AGE_BANDS)} AS faixa_etaria,
  {label('o_orderkey % 5', PARTNER_KINDS)} AS id_socio
FROM orders"""

SQL["code_label_beside"] = f"""
SELECT p_partkey, porte, {label('porte', COMPANY_SIZES)} AS nome_porte
FROM (SELECT p_partkey, CAST(p_size % 7 AS INTEGER) AS porte FROM part)"""

SQL["code_label_text"] = f"""
SELECT l_orderkey, l_linenumber, raw, {label(to_int('raw'), HEAD_OFFICE)} AS id_matriz FROM (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_orderkey % 13 = 0 THEN 'x' ELSE CAST(l_linenumber % 4 AS STRING) END AS raw
  FROM lineitem)"""

SQL["upper_trim"] = "SELECT c_custkey, trim(upper(' ' || lower(c_mktsegment) || '  ')) AS uf FROM customer"

SQL["fix_email"] = """
SELECT p_partkey, replace(trim(lower(' ' || upper(p_brand) || chr(39) || p_type || '.COM ')), chr(39), '@') AS email
FROM part"""

SQL["blank_sentinels"] = """
SELECT c_custkey, CASE WHEN raw IN ('S/N', 'S/N B') THEN '' ELSE raw END AS numero FROM (
  SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'S/N' WHEN 1 THEN 'S/N B' WHEN 2 THEN NULL
    ELSE CAST(c_custkey AS STRING) END AS raw
  FROM customer)"""

_UNKNOWN = UNKNOWN_MUNICIPALITY
SQL["split_take"] = f"""
SELECT c_custkey,
  {initcap(f"coalesce(string_split(raw, '-')[2], '{_UNKNOWN}')")} AS municipio,
  {initcap(f"coalesce(CASE WHEN strpos(raw, '-') > 0 THEN substr(raw, strpos(raw, '-') + 1) END, '{_UNKNOWN}')")}
    AS municipio_full
FROM (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'SP-' || c_mktsegment
        WHEN 1 THEN 'RJ-' || lower(c_mktsegment) || '-sai' WHEN 2 THEN c_mktsegment END AS raw
      FROM customer)"""

SQL["typed_by_group"] = f"""
SELECT o_orderkey,
  {to_int("CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE CAST(o_custkey AS STRING) END")} AS cod_cliente,
  {clean('o_orderpriority')} AS nome_prioridade,
  {to_date(f"CASE WHEN o_orderkey % 7 = 0 THEN '00000000' ELSE {_YMD_O} END")} AS data_pedido,
  CAST(o_totalprice AS STRING) AS valor
FROM orders"""

SQL["rename_map"] = f"""
SELECT o_orderkey, {D.ym('o_orderdate')} AS data, CAST(o_custkey % 5 AS STRING) AS cod_regiao,
  CAST(o_orderkey % 3 - 1 AS STRING) AS saldo_movimentacao
FROM orders"""

# ---- lookups ------------------------------------------------------------------------------------------

_KEYED_LI = """f AS (SELECT l_orderkey, l_linenumber,
  CASE WHEN l_orderkey % 9 = 0 THEN 99 ELSE CAST(l_suppkey % 25 AS INTEGER) END AS cod_pais FROM lineitem)"""

SQL["left_lookup"] = f"""
WITH {_KEYED_LI}, {lookup_cte('d', 'nation', 'pais')}
SELECT f.l_orderkey, f.l_linenumber, f.cod_pais, d.nome_pais FROM f LEFT JOIN d ON f.cod_pais = d.cod_pais"""

SQL["inner_lookup"] = f"""
WITH {_KEYED_LI}, {lookup_cte('d', 'nation', 'pais')}
SELECT f.l_orderkey, f.l_linenumber, f.cod_pais, d.nome_pais FROM f JOIN d ON f.cod_pais = d.cod_pais"""

SQL["lookup_unmatched"] = f"""
WITH {_KEYED_LI}, {lookup_cte('d', 'nation', 'pais')}
SELECT f.l_orderkey, f.l_linenumber, f.cod_pais FROM f
WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.cod_pais = f.cod_pais)"""

_SKEWED_LI = """f AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 7
  WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 9 = 1 THEN 99
  ELSE CAST(l_suppkey % 25 AS INTEGER) END AS cod_pais FROM lineitem)"""

SQL["left_lookup_salted"] = f"""
WITH {_SKEWED_LI}, {lookup_cte('d', 'nation', 'pais')}
SELECT f.l_orderkey, f.l_linenumber, f.cod_pais, d.nome_pais FROM f LEFT JOIN d ON f.cod_pais = d.cod_pais"""

SQL["lookup_unmatched_salted"] = f"""
WITH {_SKEWED_LI}, {lookup_cte('d', 'nation', 'pais')}
SELECT f.l_orderkey, f.l_linenumber, f.cod_pais FROM f
WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.cod_pais = f.cod_pais)"""

SQL["star_lookup_salted"] = f"""
WITH f AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '1' ELSE CAST(user_id % 7 AS STRING) END AS cod_regiao,
    CASE WHEN event_id % 2 = 0 THEN '4' ELSE CAST(event_id % 30 AS STRING) END AS cod_uf FROM events),
  r AS (SELECT CAST(r_regionkey AS STRING) AS k, {clean('r_name')} AS v FROM region),
  n AS (SELECT CAST(n_nationkey AS STRING) AS k, {clean('n_name')} AS v FROM nation)
SELECT f.event_id, r.v AS regiao, n.v AS uf
FROM f LEFT JOIN r ON f.cod_regiao = r.k LEFT JOIN n ON f.cod_uf = n.k"""

SQL["role_lookup"] = f"""
WITH f AS (SELECT l_orderkey, l_linenumber, CAST(l_suppkey % 25 AS INTEGER) AS cod_qual_socio,
    CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE CAST(l_partkey % 30 AS INTEGER) END AS cod_qual_socio_rep_legal
  FROM lineitem), {lookup_cte('d', 'nation', 'qual_socio')}
SELECT f.l_orderkey, f.l_linenumber, f.cod_qual_socio, d1.nome_qual_socio, f.cod_qual_socio_rep_legal,
  d2.nome_qual_socio AS nome_qual_socio_rep_legal
FROM f LEFT JOIN d d1 ON f.cod_qual_socio = d1.cod_qual_socio
       LEFT JOIN d d2 ON f.cod_qual_socio_rep_legal = d2.cod_qual_socio"""

SQL["star_lookup"] = f"""
WITH f AS (SELECT event_id, CAST(user_id % 7 AS STRING) AS cod_regiao, CAST(event_id % 30 AS STRING) AS cod_uf,
    CAST(user_id % 25 AS STRING) AS cod_secao FROM events),
  r AS (SELECT CAST(r_regionkey AS STRING) AS k, {clean('r_name')} AS v FROM region),
  n AS (SELECT CAST(n_nationkey AS STRING) AS k, {clean('n_name')} AS v FROM nation)
SELECT f.event_id, r.v AS regiao, n1.v AS uf, n2.v AS secao
FROM f LEFT JOIN r ON f.cod_regiao = r.k LEFT JOIN n n1 ON f.cod_uf = n1.k LEFT JOIN n n2 ON f.cod_secao = n2.k"""

# ---- whole tables -------------------------------------------------------------------------------------

_LOOKUP_SOURCES = {"mun": "nation", "pais": "region", "cnae": "part", "natju": "supplier", "motivo": "customer",
                   "qual_socio": "nation"}


def _lookup_union(sources: dict) -> str:
    parts = []
    for name, src in sources.items():
        maker = {"nation": fx.lookup_nation, "region": fx.lookup_region, "part": fx.lookup_part,
                 "supplier": fx.lookup_supplier, "customer": fx.lookup_customer}[src]
        (_, code_e), (_, nome_e) = maker(name)
        parts.append(f"SELECT {to_int(code_e)} AS code, {clean(nome_e)} AS name, '{name}' AS lookup FROM {src}")
    return "\nUNION ALL\n".join(parts)


SQL["consolidate_lookups"] = _lookup_union(_LOOKUP_SOURCES)

_REGIME_SQL = f"""
SELECT lpad(cnpj, 8, '0') AS cnpj, opcao_simples, {to_date('data_inclusao_simples')} AS data_inclusao_simples,
  {to_date('data_exclusao_simples')} AS data_exclusao_simples, opcao_mei,
  {to_date('data_inclusao_mei')} AS data_inclusao_mei, {to_date('data_exclusao_mei')} AS data_exclusao_mei
FROM (SELECT {select(fx.raw_regime(D))} FROM orders)"""
SQL["consolidate_regime"] = _REGIME_SQL

SQL["consolidate_partners"] = f"""
WITH raw AS (SELECT {select(fx.raw_partners(D))} FROM orders JOIN customer ON o_custkey = c_custkey),
  {lookup_cte('qs', 'nation', 'qual_socio')}, {lookup_cte('pa', 'region', 'pais')},
  t AS (SELECT lpad(cnpj_empresa, 8, '0') AS cnpj_empresa, {clean('nome_socio')} AS nome_socio, cpf_cnpj_socio,
          {label(to_int('id_socio'), PARTNER_KINDS)} AS id_socio, {label(to_int('faixa_etaria'), AGE_BANDS)} AS faixa_etaria,
          {to_int('cod_qual_socio')} AS cod_qual_socio, {to_date('data_entrada_sociedade')} AS data_entrada_sociedade,
          {to_int('cod_pais')} AS cod_pais, num_rep_legal, {clean('nome_rep_legal')} AS nome_rep_legal,
          {to_int('cod_qual_socio_rep_legal')} AS cod_qual_socio_rep_legal
        FROM raw)
SELECT t.cnpj_empresa, t.nome_socio, t.cpf_cnpj_socio, t.id_socio, t.faixa_etaria, t.cod_qual_socio,
  q1.nome_qual_socio, t.data_entrada_sociedade, t.cod_pais, pa.nome_pais, t.num_rep_legal, t.nome_rep_legal,
  t.cod_qual_socio_rep_legal, q2.nome_qual_socio AS nome_qual_socio_rep_legal
FROM t LEFT JOIN qs q1 ON t.cod_qual_socio = q1.cod_qual_socio
       LEFT JOIN qs q2 ON t.cod_qual_socio_rep_legal = q2.cod_qual_socio
       LEFT JOIN pa ON t.cod_pais = pa.cod_pais"""

SQL["consolidate_companies"] = f"""
WITH raw AS (SELECT {select(fx.raw_companies(D))} FROM customer),
  {lookup_cte('nj', 'nation', 'natju')}, {lookup_cte('qs', 'region', 'qual_socio')},
  t AS (SELECT lpad(cnpj, 8, '0') AS cnpj, {clean('razao_social')} AS razao_social,
          TRY_CAST(replace(capital_social, ',', '.') AS FLOAT) AS capital_social, {to_int('porte')} AS porte,
          {label(to_int('porte'), COMPANY_SIZES)} AS nome_porte, {clean('ente_fed_resp')} AS ente_fed_resp,
          {to_int('cod_natju')} AS cod_natju, {to_int('cod_qual_socio')} AS cod_qual_socio
        FROM raw)
SELECT t.cnpj, t.razao_social, t.capital_social, t.porte, t.nome_porte, t.ente_fed_resp, t.cod_natju, nj.nome_natju,
  t.cod_qual_socio, qs.nome_qual_socio
FROM t LEFT JOIN nj ON t.cod_natju = nj.cod_natju LEFT JOIN qs ON t.cod_qual_socio = qs.cod_qual_socio"""

_ESTAB_TYPED = {
    "cnpj": "lpad(cnpj, 8, '0')",
    "id_matriz": label(to_int("id_matriz"), HEAD_OFFICE),
    "nome_fantasia": clean("nome_fantasia"),
    "situacao_cadastral": to_int("situacao_cadastral"),
    "data_situacao_cadastral": to_date("data_situacao_cadastral"),
    "motivo_situacao_cadastral": to_int("motivo_situacao_cadastral"),
    "nome_cidade_ext": clean("nome_cidade_ext"),
    "cod_pais": to_int("cod_pais"),
    "data_inicio_atividades": to_date("data_inicio_atividades"),
    "cnae_primario": "lpad(cnae_primario, 7, '0')",
    "tipo_logradouro": clean("tipo_logradouro"),
    "logradouro": clean("logradouro"),
    "numero": "CASE WHEN numero IN ('S/N', 'S/N B') THEN '' ELSE numero END",
    "complemento": clean("complemento"),
    "bairro": clean("bairro"),
    "uf": "trim(upper(uf))",
    "cod_mun": to_int("cod_mun"),
    "correio_eletronico": "replace(trim(lower(correio_eletronico)), chr(39), '@')",
    "data_situacao_especial": to_date("data_situacao_especial"),
}


def _estab_sql() -> str:
    typed = ", ".join(f"{_ESTAB_TYPED.get(c, c)} AS {c}" for c in ESTAB_COLUMNS)
    out = ", ".join(f"t.{c}" for c in ESTAB_COLUMNS)
    return f"""
WITH raw AS (SELECT {select(fx.raw_establishments(D))}
             FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
  {lookup_cte('mu', 'nation', 'mun')}, {lookup_cte('pa', 'region', 'pais')},
  t AS (SELECT {typed}, lpad(cnpj, 8, '0') || cnpj_ordem || cnpj_dv AS cnpj_completo FROM raw)
SELECT {out}, mu.nome_mun, pa.nome_pais, t.cnpj_completo
FROM t JOIN mu ON t.cod_mun = mu.cod_mun LEFT JOIN pa ON t.cod_pais = pa.cod_pais"""


SQL["consolidate_establishments"] = _estab_sql()


def _flows_sql(level: str, codes: dict, raw_pairs, source: str) -> str:
    ctes, joins, labels = [], [], {}
    raw_names = {v: k for k, v in HEADERS[level].items()}  # cod_x -> header
    for name, (src, _) in codes.items():
        (_, code_e), (_, label_e) = fx.codebook_rows(name, src)
        ctes.append(f"cb_{name} AS (SELECT {code_e} AS k, {clean(label_e)} AS v FROM {fx.codebook_table(src)})")
        joins.append(f"LEFT JOIN cb_{name} ON raw.{q(raw_names['cod_' + name])} = cb_{name}.k")
        labels[name] = f"cb_{name}.v"
    labels["municipio"] = initcap(f"coalesce(string_split({labels['municipio']}, '-')[2], '{_UNKNOWN}')")
    cols = []
    for header, target in HEADERS[level].items():
        out = target.removeprefix("cod_")
        if target == "data":
            e = to_date(f"raw.{q(header)}", "%Y%m")
        elif target in INTEGERS[level]:
            e = to_int(f"raw.{q(header)}")
        elif target == "salario":
            e = f"TRY_CAST(raw.{q(header)} AS DOUBLE)"
        else:
            e = labels[out]
        cols.append(f"{e} AS {out}")
    return f"""
WITH raw AS (SELECT {select(raw_pairs)} FROM {source}), {', '.join(ctes)}
SELECT {', '.join(cols)}
FROM raw {' '.join(joins)}"""


SQL["consolidate_movements"] = _flows_sql("mov", fx.MOV_CODES, fx.raw_movements(D), "events")
SQL["consolidate_estab_flows"] = _flows_sql("estab", fx.ESTAB_FLOW_CODES, fx.raw_estab_flows(D),
                                            "orders JOIN customer ON o_custkey = c_custkey")

# ---- scans and sinks ----------------------------------------------------------------------------------

# a text value written to CSV and read back: '' and null both come back as null
SQL["scan_positional"] = """
SELECT CAST(doc_id AS STRING) AS doc_id, NULLIF(text, '') AS texto, NULLIF(lang, '') AS lang, NULLIF(source, '') AS source,
  CAST(n_chars AS STRING) AS n_chars
FROM documents"""

SQL["scan_headered"] = "SELECT CAST(event_id AS STRING) AS event_id, " + ", ".join(
    f"{e} AS {q(MOV_HEADERS.get(c, c))}" for c, e in fx.raw_movements(D)) + " FROM events"

SQL["scan_glob"] = _REGIME_SQL

SQL["scan_lookup_set"] = _lookup_union({
    LOOKUP_IDS[i]: src for i, src in
    {"CNAE": "part", "MUNIC": "nation", "NATJU": "supplier", "PAIS": "region", "QUALS": "nation", "MOTI": "customer"}.items()
})

SQL["sink_roundtrip"] = "SELECT * FROM orders"
SQL["sink_modes"] = "SELECT * FROM customer UNION ALL SELECT * FROM customer"
SQL["sink_partitioned"] = "SELECT * FROM orders"
SQL["sink_partition_count"] = "SELECT * FROM lineitem"
SQL["staged_consolidation"] = SQL["consolidate_establishments"]

# ---- ingestion ----------------------------------------------------------------------------------------

# The pages hold double-quoted values only (the other forms are covered by unit tests).
SQL["extract_links"] = """
SELECT page_id, replace(link, '&amp;', '&') AS link
FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS link FROM pages)"""
SQL["extract_links_suffix"] = f"SELECT * FROM ({SQL['extract_links']}) WHERE link LIKE '%e'"

_PARSED = f"""
SELECT event_id, folder, CAST(try_strptime(parts[1], '%m-%d-%y') AS DATE) AS release_date, parts[-1] AS name
FROM (SELECT event_id, folder, string_split(regexp_replace(trim(line), ' +', ' ', 'g'), ' ') AS parts
      FROM (SELECT {select(fx.listing_lines(D))} FROM events))"""
SQL["parse_listing"] = _PARSED
SQL["latest_release"] = f"""
SELECT folder, name, release_date FROM (
  SELECT folder, name, release_date,
    row_number() OVER (PARTITION BY folder ORDER BY release_date DESC, name DESC) AS rn
  FROM ({_PARSED}) WHERE release_date IS NOT NULL)
WHERE rn = 1"""

SQL["fetch_plan"] = """
SELECT m.name FROM (SELECT 'F' || CAST(p_partkey AS STRING) || '.zip' AS name FROM part) m
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE 'F' || CAST(l_suppkey AS STRING) = regexp_replace(m.name, '\\.zip$', ''))"""

SQL["expand_archives"] = """
SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS BIGINT) AS line_number, unnest(parts) AS line
FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)"""

_SHEETS = ", ".join(f"('{s.lower()}', '{f.removesuffix('.csv')}')" for s, f in MOV_SHEETS.items())
SQL["split_codebooks"] = f"""
WITH long AS (SELECT {select(fx.long_codebook(D))} FROM customer),
  names(sheet_key, codebook) AS (VALUES {_SHEETS})
SELECT n.codebook, l.code, l.description FROM long l JOIN names n ON lower(l.sheet) = n.sheet_key"""


def _tiered_sql() -> str:
    gaz = fx.gazetteer(D)
    union = " UNION ALL ".join(f"SELECT {select(pairs)} FROM supp" for pairs in gaz.values())
    keys = {"address": "concat_ws(', ', a.rua, a.bairro, a.municipio, a.uf)",
            "district": "concat_ws(', ', a.bairro, a.municipio, a.uf)",
            "zip": "concat_ws(', ', a.cep, a.municipio, a.uf)"}
    joins = " ".join(f"LEFT JOIN best b_{t} ON b_{t}.grain = '{t}' AND b_{t}.key = {k}" for t, k in keys.items())
    fields = ", ".join(f"b_{t}.{c} AS {t}_{c}" for t in keys for c in ("matched_address", "lat", "lng", "score", "quality"))
    pick = lambda f: f"CASE match_tier WHEN 'address' THEN address_{f} WHEN 'district' THEN district_{f} WHEN 'zip' THEN zip_{f} END"
    return f"""
WITH geo AS (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey),
  addrs AS (SELECT {select(fx.addresses(D))} FROM customer JOIN geo ON c_nationkey = n_nationkey),
  supp AS (SELECT * FROM supplier JOIN geo ON s_nationkey = n_nationkey),
  gaz AS ({union}),
  best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grain, key
             ORDER BY score DESC, lat DESC, lng DESC, matched_address DESC, quality DESC) AS rn FROM gaz) WHERE rn = 1),
  j AS (SELECT a.c_custkey, a.municipio, {fields} FROM addrs a {joins}),
  t AS (SELECT *, CASE
      WHEN contains(address_matched_address, municipio) AND (address_score = 100
           OR (address_score >= 80 AND address_quality IN ('PointAddress', 'StreetAddress'))) THEN 'address'
      WHEN contains(district_matched_address, municipio) AND district_score >= 80 THEN 'district'
      WHEN zip_matched_address IS NOT NULL THEN 'zip' END AS match_tier FROM j)
SELECT c_custkey, match_tier, {pick('lat')} AS lat, {pick('lng')} AS lng FROM t"""


SQL["tiered_match"] = _tiered_sql()


def _fuzzy_sql() -> str:
    """Every address key against every gazetteer key."""
    gaz = " UNION ALL ".join(f"SELECT {select(pairs)} FROM supp" for pairs in fx.gazetteer(D).values())
    keys = {"address": "concat_ws(', ', rua, bairro, municipio, uf)", "district": "concat_ws(', ', bairro, municipio, uf)",
            "zip": "concat_ws(', ', cep, municipio, uf)"}
    asked = " UNION ALL ".join(f"SELECT c_custkey, '{t}' AS grain, municipio, {k} AS key FROM addrs" for t, k in keys.items())
    words = ("list_distinct(list_filter(string_split(regexp_replace(lower(" + fold("key")
             + "), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> ''))")
    return f"""
WITH geo AS (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey),
  addrs AS (SELECT {select(fx.misspelt_addresses(D))} FROM customer JOIN geo ON c_nationkey = n_nationkey),
  supp AS (SELECT * FROM supplier JOIN geo ON s_nationkey = n_nationkey),
  gaz AS (SELECT *, {words} AS w FROM ({gaz})),
  asked AS (SELECT *, {words} AS w FROM ({asked})),
  scored AS (SELECT a.c_custkey, a.municipio, grain, lat, lng, matched_address, quality,
      200 * len(list_intersect(a.w, g.w)) // (len(a.w) + len(g.w)) AS score FROM asked a JOIN gaz g USING (grain)),
  best AS (SELECT * FROM scored WHERE score >= 80 QUALIFY row_number() OVER (PARTITION BY c_custkey, grain
      ORDER BY score DESC, lat DESC, lng DESC, matched_address DESC, quality DESC) = 1),
  good AS (SELECT *, CASE grain WHEN 'address' THEN 1 WHEN 'district' THEN 2 ELSE 3 END AS turn FROM best WHERE
      CASE grain WHEN 'address' THEN contains(matched_address, municipio) AND (score = 100 OR quality IN ('PointAddress', 'StreetAddress'))
        WHEN 'district' THEN contains(matched_address, municipio) ELSE true END
      QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY turn) = 1)
SELECT addrs.c_custkey, grain AS match_tier, lat, lng FROM addrs LEFT JOIN good USING (c_custkey)"""


SQL["tiered_match_fuzzy"] = _fuzzy_sql()
SQL["incremental_ingest"] = _REGIME_SQL
SQL["register_run"] = SQL["consolidate_establishments"]
SQL["labour_run"] = SQL["consolidate_movements"]


def _parsed(pairs, source: str) -> str:
    return f"""SELECT folder, CAST(try_strptime(parts[1], '%m-%d-%y') AS DATE) AS release_date, parts[-1] AS name
FROM (SELECT folder, string_split(regexp_replace(trim(line), ' +', ' ', 'g'), ' ') AS parts
      FROM (SELECT {select(pairs)} FROM {source}))"""


_TREE = fx.release_tree(D)
SQL["latest_path"] = f"""
WITH y AS ({_parsed(_TREE['years'], 'orders')}),
  m AS ({_parsed(_TREE['months'], 'orders')}),
  best_y AS (SELECT folder AS root, name, release_date FROM (
      SELECT *, row_number() OVER (PARTITION BY folder ORDER BY release_date DESC, name DESC) AS rn
      FROM y WHERE release_date IS NOT NULL) WHERE rn = 1),
  best_m AS (SELECT root, path, name, release_date FROM (
      SELECT best_y.root, best_y.name AS path, m.name, m.release_date,
        row_number() OVER (PARTITION BY best_y.root ORDER BY m.release_date DESC, m.name DESC) AS rn
      FROM m JOIN best_y ON m.folder = best_y.root || '/' || best_y.name WHERE m.release_date IS NOT NULL) WHERE rn = 1)
SELECT root, path || '/' || name AS path, name, release_date FROM best_m"""
SQL["release_files"] = f"""
WITH newest AS ({SQL["latest_path"]}), files AS ({_parsed(_TREE['files'], 'orders')})
SELECT n.root, n.path, f.name FROM files f JOIN newest n ON f.folder = n.root || '/' || n.path"""

_REGISTER_LOOKUPS = {"mun": "nation", "pais": "region", "cnae": "part", "natju": "nation", "motivo": "customer", "qual_socio": "nation"}
for _name, _source in _REGISTER_LOOKUPS.items():
    SQL[f"register_run_{_name}"] = f"WITH {lookup_cte('d', _source, _name)} SELECT * FROM d"
SQL["register_run_simples"] = _REGIME_SQL
SQL["register_run_socios"] = SQL["consolidate_partners"]
# The run's dumps share one nation-based lookup for qual_socio, the single-table query a region-based one.
SQL["register_run_empresas"] = SQL["consolidate_companies"].replace(
    lookup_cte("qs", "region", "qual_socio"), lookup_cte("qs", "nation", "qual_socio"))
SQL["labour_run_estab"] = SQL["consolidate_estab_flows"]

# ---- what is lost and what is rejected ---------------------------------------------------------------


def _loss_sql() -> str:
    ints = ("situacao_cadastral", "motivo_situacao_cadastral", "cod_pais", "cod_mun")
    dates = ("data_situacao_cadastral", "data_inicio_atividades", "data_situacao_especial")
    filled = "{c} IS NOT NULL AND trim({c}) <> ''"
    tests = {c: f"{filled.format(c=c)} AND {to_int(c)} IS NULL" for c in ints}
    tests |= {c: f"{filled.format(c=c)} AND NOT regexp_matches({c}, '^[0 ]*$') AND {to_date(c)} IS NULL" for c in dates}
    typing = " UNION ALL ".join(f"SELECT 'typing' AS step, '{c}' AS column_name, count(*) FILTER ({t}) AS lost, count(*) AS seen FROM raw"
                                for c, t in tests.items())
    return f"""
WITH raw AS (SELECT {select(fx.raw_establishments(D))}
             FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
  {lookup_cte('mu', 'nation', 'mun')}, {lookup_cte('pa', 'region', 'pais')},
  known AS (SELECT *, {to_int('cod_mun')} IN (SELECT cod_mun FROM mu) AS hit FROM raw)
SELECT 'df_estab' AS table_name, * FROM (
  {typing}
  UNION ALL SELECT 'inner lookup', 'cod_mun', count(*) FILTER (hit IS NOT TRUE), count(*) FROM known
  UNION ALL SELECT 'left lookup', 'cod_pais',
    count(*) FILTER ({to_int('cod_pais')} IS NOT NULL AND {to_int('cod_pais')} NOT IN (SELECT cod_pais FROM pa)), count(*)
    FROM known WHERE hit)"""


SQL["loss_report"] = _loss_sql()

SQL["scan_rejects"] = f"""
WITH raw AS (SELECT o_orderkey % 10 AS k, CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority, o_orderstatus AS status,
               {D.ymd('o_orderdate')} AS day, {fx.order_lines(D)[0][1]} AS line FROM orders),
  judged AS (SELECT *, CASE k WHEN 0 THEN 'short' WHEN 1 THEN 'long' WHEN 2 THEN 'broken' ELSE 'ok' END AS row_status FROM raw)
SELECT CASE WHEN row_status = 'ok' THEN o_orderkey END AS o_orderkey,
  CASE WHEN row_status = 'ok' THEN CASE k WHEN 3 THEN 'a;b "' || o_orderpriority || '"' WHEN 4 THEN '5" of it' ELSE o_orderpriority END END AS priority,
  CASE WHEN row_status = 'ok' THEN status END AS status,
  CASE WHEN row_status = 'ok' AND k <> 4 THEN day END AS day,
  row_status, CASE WHEN row_status <> 'ok' THEN line END AS line
FROM judged"""

# ---- deep trees and links ----------------------------------------------------------------------------

SQL["latest_path_deep"] = f"""
WITH RECURSIVE entries AS (
    SELECT concat_ws('/', folder, e.below) AS folder, e.line AS line
    FROM (SELECT folder, unnest(lines) AS e FROM (SELECT {select(fx.deep_listing(D))} FROM orders)) WHERE e.line LIKE '%<DIR>%'
), dated AS ({_parsed([("folder", "folder"), ("line", "line")], "entries")}),
newest AS (SELECT folder, name, release_date FROM dated WHERE release_date IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY folder ORDER BY release_date DESC, name DESC) = 1),
walk AS (
    SELECT folder AS root, name AS path, name, release_date, 1 AS depth FROM newest WHERE NOT contains(substr(folder, 6), '/')
    UNION ALL
    SELECT w.root, w.path || '/' || n.name, n.name, n.release_date, w.depth + 1 FROM walk w JOIN newest n ON n.folder = w.root || '/' || w.path
)
SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY root ORDER BY depth DESC) = 1"""


def _url(x: str, name: str) -> str:
    """Columns name_s, name_a, name_p, name_q of the parts of a reference, from the front to the back."""
    scheme = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
    rest = f"regexp_replace(regexp_replace({x}, '{scheme}', ''), '#.*$', '', 's')"
    path = f"split_part({rest}, '?', 1)"
    return f"""nullif(lower(regexp_extract({x}, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1)), '') AS {name}_s,
      CASE WHEN {path} LIKE '//%' THEN regexp_extract({path}, '^//([^/]*)', 1) END AS {name}_a,
      CASE WHEN {path} LIKE '//%' THEN regexp_replace({path}, '^//[^/]*', '') ELSE {path} END AS {name}_p,
      CASE WHEN contains({rest}, '?') THEN substr({rest}, strpos({rest}, '?') + 1) END AS {name}_q"""


def _percent(x: str) -> str:
    char = "chr(CAST('0x' || p[1:2] AS INTEGER))"
    encoded = (f"array_to_string(list_transform(string_split({x}, ''), lambda ch: CASE WHEN regexp_matches(ch, '[^!-~]') "
               f"THEN regexp_replace(hex(encode(ch)), '(..)', '%\\1', 'g') ELSE ch END), '')")
    return (f"array_to_string(list_transform(list_zip(string_split({encoded}, '%'), range(1 + len(string_split({encoded}, '%')))), lambda z: "
            f"CASE WHEN z[2] = 0 THEN z[1] WHEN regexp_matches(z[1], '^[0-9A-Fa-f]{{2}}') THEN "
            f"CASE WHEN regexp_matches({char.replace('p[', 'z[1][')}, '^[A-Za-z0-9\\-._~]$') THEN {char.replace('p[', 'z[1][')} "
            f"ELSE '%' || upper(z[1][1:2]) END || z[1][3:] ELSE '%' || z[1] END), '')")


def _resolved_sql(links: str) -> str:
    """``links`` (page_id, url, link) with the link's target."""
    fold = ("list_reduce(list_prepend('', string_split(path[2:], '/')), lambda kept, s: CASE s WHEN '.' THEN kept "
            "WHEN '..' THEN regexp_replace(kept, '/[^/]*$', '') ELSE kept || '/' || s END)")
    return f"""
WITH found AS ({links}),
  parts AS (SELECT *, {_url("trim(link)", "r")}, {_url("url", "b")} FROM found),
  aimed AS (SELECT page_id, url, link, coalesce(r_s, b_s) AS scheme,
      CASE WHEN r_s IS NOT NULL OR r_a IS NOT NULL THEN r_a ELSE b_a END AS authority,
      CASE WHEN r_s IS NOT NULL OR r_a IS NOT NULL OR r_p LIKE '/%' THEN r_p WHEN r_p = '' THEN b_p
        WHEN b_p = '' THEN '/' || r_p ELSE regexp_replace(b_p, '[^/]*$', '') || r_p END AS path,
      CASE WHEN r_s IS NOT NULL OR r_a IS NOT NULL OR r_p <> '' THEN r_q ELSE coalesce(r_q, b_q) END AS query FROM parts),
  folded AS (SELECT * EXCLUDE (path, authority), CASE WHEN path LIKE '/%' THEN {fold} || CASE WHEN regexp_matches(path, '(^|/)\\.\\.?$') THEN '/' ELSE '' END
        ELSE path END AS path,
      regexp_extract(authority, '^(.*@)?', 1) || lower(regexp_replace(regexp_replace(regexp_replace(authority, '^.*@', ''),
        CASE scheme WHEN 'http' THEN ':80$' WHEN 'https' THEN ':443$' WHEN 'ftp' THEN ':21$' ELSE '^$' END, ''), ':$', '')) AS authority FROM aimed)
SELECT page_id, url, link, coalesce(scheme || ':', '') || coalesce('//' || authority, '')
    || CASE WHEN authority IS NOT NULL AND path = '' THEN '/' ELSE {_percent("path")} END || CASE WHEN query IS NULL THEN '' ELSE '?' || {_percent("query")} END AS target
FROM folded"""


_REFERENCES = ", ".join(f"'{x}'" for x in fx.REFERENCES)
SQL["resolved_links"] = _resolved_sql(f"""
    SELECT page_id, url, replace(link, '&amp;', '&') AS link
    FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS link FROM pages)
    UNION ALL SELECT page_id, url, unnest([{_REFERENCES}]) AS link FROM pages""")
_FILES = _resolved_sql("SELECT page_id, url, unnest(['f' || page_id % 9 || '.zip?v=' || page_id % 2, '../d/./f' || page_id % 7 || '.zip#x', '/g.txt']) AS link FROM pages")
SQL["link_manifest"] = f"SELECT DISTINCT regexp_extract(target, '([^/]*\\.zip)(\\?.*)?$', 1) AS name, target FROM ({_FILES}) WHERE target LIKE '%.zip' OR target LIKE '%.zip?%'"

_PUBLISHED = {name: SQL[f"register_run_{name}"] for name in ("simples", "socios", "empresas", *LOOKUP_IDS.values())} | {
    "estab": SQL["register_run"]}
SQL["register_publish"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, concat_ws('|', *COLUMNS(*{' EXCLUDE (capital_social)' if name == 'empresas' else ''})) AS content FROM ({sql})"
    for name, sql in _PUBLISHED.items())

SQL["sink_clustered"] = "SELECT * FROM lineitem"
SQL["incremental_dedup"] = SQL["incremental_ingest"]
