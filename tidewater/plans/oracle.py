"""Independent DuckDB SQL twins of the Spark plans (the correctness oracle).

Written as plain ANSI-ish SQL over the driver's pre-registered views; the
Spark side is DataFrame code, so agreement of the two is a real check. Each
named CTE lists the CTEs it reads; ``sql_for`` emits only those needed, in
dependency order, followed by the final SELECT.
"""

from __future__ import annotations

from tidewater.sources.bronze import (BOOL_SPELLINGS, BRANDS, CAMPAIGNS, CODE_WIDTH, GENERIC_CATEGORIES,
                                      PHYSICAL_SPELLINGS, TX_SPELLINGS, VIRTUAL_SPELLINGS)
from tidewater.plans.clean import MERCHANT_CATEGORY_FIX
from tidewater.functions.text import ACCENTED, FALSE_WORDS, NULL_WORDS, PLAIN, TRUE_WORDS
from tidewater.session import Params

P = Params()


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lst(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def pick(values, idx: str) -> str:
    return f"{lst(values)}[CAST(({idx}) AS INTEGER) + 1]"


def fmt_date(d: str, mode: str) -> str:
    return (f"CASE ({mode}) WHEN 0 THEN strftime({d}, '%Y-%m-%d') WHEN 1 THEN strftime({d}, '%d/%m/%Y') "
            f"ELSE CAST(CAST(date_diff('day', DATE '1970-01-01', {d}) AS BIGINT) * 86400000 AS VARCHAR) END")


def idp(prefix: str, k: str, w: int) -> str:
    return f"('{prefix}' || lpad(CAST({k} AS VARCHAR), {w}, '0'))"


# ---------------------------------------------------------------- column macros

def norm(x: str) -> str:
    return (f"translate(lower(regexp_replace(trim({x}), '\\s+', ' ', 'g')), "
            f"'{ACCENTED}', '{PLAIN}')")


def code(x: str) -> str:
    return f"regexp_replace({norm(x)}, '\\s+', '_', 'g')"


def title(x: str) -> str:
    return f"array_to_string(list_transform(string_split({norm(x)}, ' '), lambda w: upper(w[1]) || substr(w, 2)), ' ')"


def null_word(x: str) -> str:
    return f"CASE WHEN {norm(x)} IN ({', '.join(q(w) for w in NULL_WORDS)}) THEN NULL ELSE {x} END"


def boolean(x: str) -> str:
    n = norm(x)
    return (f"CASE WHEN {n} IN ('nan', '') THEN NULL WHEN {n} IN ({', '.join(q(w) for w in TRUE_WORDS)}) THEN TRUE "
            f"WHEN {n} IN ({', '.join(q(w) for w in FALSE_WORDS)}) THEN FALSE ELSE NULL END")


def digits(x: str) -> str:
    return f"regexp_replace(trim({x}), '[^0-9]', '', 'g')"


def money(x: str) -> str:
    return f"TRY_CAST(regexp_replace(trim({x}), '[$,]', '', 'g') AS DECIMAL(12,2))"


def pdate(x: str) -> str:
    t = f"trim({x})"
    ms = f"TRY_CAST({t} AS BIGINT)"
    return (f"CASE WHEN regexp_full_match({t}, '\\d+') THEN "
            f"(CASE WHEN {ms} >= 0 AND {ms} < 253402300800000 "
            f"THEN DATE '1970-01-01' + CAST(floor({ms} / 86400000) AS INTEGER) END) "
            f"WHEN regexp_full_match({t}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN CAST(try_strptime({t}, '%Y-%m-%d') AS DATE) "
            f"WHEN regexp_full_match({t}, '\\d{{2}}/\\d{{2}}/\\d{{4}}') THEN CAST(try_strptime({t}, '%d/%m/%Y') AS DATE) "
            f"ELSE NULL END")


def age(birth: str, as_of: str = P.as_of) -> str:
    return f"CAST(floor(date_diff('day', {birth}, DATE '{as_of}') / 365.25) AS BIGINT)"


def ddiff(later: str, earlier: str) -> str:
    return f"CAST(date_diff('day', {earlier}, {later}) AS INTEGER)"


def rate(value: str, days: str) -> str:
    return f"CASE WHEN {days} >= 30 THEN {value} / ({days} / CAST(30.44 AS DOUBLE)) END"


def cat_map(key: str, default: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in MERCHANT_CATEGORY_FIX.items())
    return f"CASE {key} {whens} ELSE {default} END"


# ---------------------------------------------------------------- CTE registry

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


# bronze --------------------------------------------------------------------
_k = "c.c_custkey"
_cid = idp("CHK-", _k, 6)
_ced_k = f"CASE WHEN {_k} % 97 = 0 AND {_k} > 0 THEN {_k} - 1 ELSE {_k} END"
_ced = f"('17' || lpad(CAST((({_ced_k}) * 7919) % 100000000 AS VARCHAR), 8, '0'))"
_birth = f"(DATE '1930-01-01' + CAST(({_k} * 131) % 33000 AS INTEGER))"
_reg = f"(DATE '1994-01-01' + CAST(({_k} * 17) % 1900 AS INTEGER))"
cte("b_clientes0", [], f"""
SELECT {_k} AS _k,
  CASE {_k} % 3 WHEN 0 THEN {_cid} WHEN 1 THEN ' ' || {_cid} ELSE {_cid} || '  ' END AS cliente_id,
  CASE WHEN {_k} % 5 = 0 THEN substr({_ced}, 1, 9) || '-' || substr({_ced}, 10, 1)
       WHEN {_k} % 7 = 0 THEN ' ' || {_ced} || ' ' ELSE {_ced} END AS cedula,
  CASE WHEN {_k} % 17 = 0 THEN '31 de marzo' ELSE {fmt_date(_birth, f'{_k} % 3')} END AS fecha_nacimiento,
  CASE {_k} % 4 WHEN 0 THEN n.n_name WHEN 1 THEN lower(n.n_name) WHEN 2 THEN '  ' || n.n_name
       ELSE replace(n.n_name, 'A', 'Á') END AS ciudad,
  CASE WHEN {_k} % 11 = 0 THEN 'N/A'
       WHEN {_k} % 11 = 1 THEN {pick(['NULL', 'None', '', 'nan'], f'({_k} // 11) % 4')}
       WHEN {_k} % 13 = 0 THEN ' ' || lower(c.c_mktsegment) || ' ' ELSE c.c_mktsegment END AS canal_adquisicion,
  CASE WHEN c.c_acctbal >= 0 THEN {pick(['Activa', 'ACTIVA ', ' activa'], f'{_k} % 3')}
       ELSE {pick(['Suspendida', 'SUSPENDIDA  '], f'{_k} % 2')} END AS estado_cuenta,
  {fmt_date(_reg, f'({_k} + 1) % 3')} AS fecha_registro
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
cte("b_clientes", ["b_clientes0"], """
SELECT cliente_id, cedula, fecha_nacimiento, ciudad, canal_adquisicion, estado_cuenta, fecha_registro FROM b_clientes0
UNION ALL
SELECT cliente_id, cedula, fecha_nacimiento, ciudad, canal_adquisicion, estado_cuenta, fecha_registro
FROM b_clientes0 WHERE _k % 50 = 0""")

_issue_v = f"(DATE '1996-01-01' + CAST({_k} % 300 AS INTEGER))"
_issue_f = f"(DATE '1999-06-01' + CAST({_k} % 45 AS INTEGER))"
_act_f = f"({_issue_f} + CAST({_k} % 25 AS INTEGER))"
_virtual = f"""SELECT {idp('TRJ-', f'{_k} * 2', 7)} AS tarjeta_id,
  CASE WHEN {_k} % 4 = 3 THEN {_cid} || ' ' ELSE {_cid} END AS cliente_id,
  {pick(VIRTUAL_SPELLINGS, f'{_k} % 6')} AS tipo,
  {fmt_date(_issue_v, f'{_k} % 3')} AS fecha_emision,
  {fmt_date(_issue_v, f'({_k} + 1) % 3')} AS fecha_activacion,
  CAST({_k} % 3 + 1 AS INTEGER) AS estado_codigo FROM customer c"""
cte("b_tarjetas", [], f"""
{_virtual} WHERE {_k} % 20 <> 0
UNION ALL
{_virtual} WHERE {_k} % 60 = 1
UNION ALL
SELECT {idp('TRJ-', f'{_k} * 2 + 1', 7)}, {_cid}, {pick(PHYSICAL_SPELLINGS, f'{_k} % 6')},
  CASE WHEN {_k} % 63 = 4 THEN NULL ELSE {fmt_date(_issue_f, f'{_k} % 3')} END,
  CASE WHEN {_k} % 2 = 0 THEN {fmt_date(_act_f, f'({_k} + 2) % 3')} ELSE NULL END,
  CAST(({_k} + 1) % 3 + 1 AS INTEGER)
FROM customer c WHERE {_k} % 9 IN (1, 2, 3, 4)
UNION ALL
SELECT 'TRJ-9' || lpad(CAST({_k} AS VARCHAR), 6, '0'), 'CHK-X' || lpad(CAST({_k} AS VARCHAR), 6, '0'), 'virtual',
  {fmt_date(_issue_v, '0')}, {fmt_date(_issue_v, '0')}, 1
FROM customer c WHERE {_k} % 40 = 7""")

_o = "o.o_orderkey"
_ocid = idp("CHK-", "o.o_custkey", 6)
_d = "CAST(o.o_orderdate AS DATE)"
_cents = "CAST(round(o.o_totalprice * 100) AS BIGINT)"
_dollars = f"({_cents} // 100)"
_body = (f"(CASE WHEN {_o} % 3 = 0 AND {_dollars} >= 1000 THEN CAST({_dollars} // 1000 AS VARCHAR) || ',' || "
         f"lpad(CAST({_dollars} % 1000 AS VARCHAR), 3, '0') ELSE CAST({_dollars} AS VARCHAR) END || '.' || "
         f"lpad(CAST({_cents} % 100 AS VARCHAR), 2, '0'))")
_spelled = "[" + ", ".join(lst(s) for s in TX_SPELLINGS) + "]"
cte("b_transacciones0", [], f"""
SELECT {_o} AS _k,
  CASE WHEN {_o} % 5 = 0 THEN ' ' || {idp('TX-', _o, 8)} ELSE {idp('TX-', _o, 8)} END AS transaccion_id,
  CASE WHEN {_o} % 127 = 9 THEN 'CHK-X' || lpad(CAST(o.o_custkey AS VARCHAR), 6, '0')
       WHEN {_o} % 4 = 1 THEN {_ocid} || ' ' ELSE {_ocid} END AS cliente_id,
  CASE WHEN {_o} % 301 = 7 THEN 'sin fecha' ELSE {fmt_date(_d, f'{_o} % 3')} END AS fecha,
  CASE WHEN {_o} % 97 = 13 THEN 'Ajuste Manual'
       ELSE {_spelled}[CAST(({_o} // 8) % 4 AS INTEGER) + 1][CAST({_o} % 8 AS INTEGER) + 1] END AS tipo_transaccion,
  CASE WHEN {_o} % 211 = 5 THEN 'nan' WHEN {_o} % 301 = 11 THEN NULL
       WHEN {_o} % 100 = 3 THEN '-' || {_body} WHEN {_o} % 2 = 0 THEN '$' || {_body} ELSE {_body} END AS monto,
  CASE WHEN {_o} % 8 = 4 AND {_o} % 97 <> 13 THEN (CASE WHEN {_o} % 7 = 0 THEN ' ' ELSE '' END) ||
       'COM-' || lpad(CAST(({_o} // 8) % (SELECT count(*) + count(*) // 10 + 3 FROM supplier) AS VARCHAR), {CODE_WIDTH}, '0') END AS comercio_codigo,
  {pick(BOOL_SPELLINGS, f'{_o} % 14')} AS es_devolucion
FROM orders o""")
cte("b_transacciones", ["b_transacciones0"], """
SELECT transaccion_id, cliente_id, fecha, tipo_transaccion, monto, comercio_codigo, es_devolucion FROM b_transacciones0
UNION ALL
SELECT transaccion_id, cliente_id, fecha, tipo_transaccion, monto, comercio_codigo, es_devolucion
FROM b_transacciones0 WHERE _k % 83 = 1""")

_e = "e.event_id"
_cust = f"({_e} % (SELECT count(*) FROM customer))"
_ecid = f"('CHK-' || lpad(CAST({_cust} AS VARCHAR), 6, '0'))"
_contact = f"(DATE '1996-01-01' + CAST(({_e} * 13) % 2000 AS INTEGER))"
cte("b_marketing0", [], f"""
SELECT {_e} AS _k, {idp('INT-', _e, 7)} AS interaccion_id,
  CASE WHEN {_e} % 151 = 3 THEN 'CHK-X' || lpad(CAST({_cust} AS VARCHAR), 6, '0')
       WHEN {_e} % 6 = 5 THEN ' ' || {_ecid} ELSE {_ecid} END AS cliente_id,
  {pick(CAMPAIGNS, "CAST(json_extract_string(e.props, '$.k') AS BIGINT) % 6")} AS campana,
  {fmt_date(_contact, f'{_e} % 3')} AS fecha_contacto,
  CASE {_e} % 3 WHEN 0 THEN e.event_type WHEN 1 THEN upper(e.event_type) ELSE ' ' || e.event_type || ' ' END AS canal,
  CASE WHEN {_e} % 29 = 0 THEN NULL ELSE {pick(BOOL_SPELLINGS, f'{_e} % 14')} END AS respondio
FROM events e""")
cte("b_marketing", ["b_marketing0"], """
SELECT interaccion_id, cliente_id, campana, fecha_contacto, canal, respondio FROM b_marketing0
UNION ALL
SELECT interaccion_id, cliente_id, campana, fecha_contacto, canal, respondio FROM b_marketing0 WHERE _k % 97 = 2""")

_s = "s.s_suppkey"
_code = f"('COM-' || lpad(CAST({_s} AS VARCHAR), {CODE_WIDTH}, '0'))"
cte("b_comercios0", [], f"""
SELECT {_s} AS _k,
  CASE WHEN {_s} % 5 = 0 THEN ' ' || {_code} || ' ' ELSE {_code} END AS comercio_codigo,
  CASE WHEN {_s} < 15 THEN {pick(BRANDS, _s)} ELSE 'Comercio ' || CAST({_s} AS VARCHAR) END AS nombre_comercio,
  CASE WHEN {_s} < 15 THEN (CASE WHEN {_s} IN (6, 7, 8) THEN 'servicios_publicos' ELSE 'otros' END)
       ELSE {pick(GENERIC_CATEGORIES, f'{_s} % 6')} END AS categoria
FROM supplier s""")
cte("b_comercios", ["b_comercios0"], """
SELECT comercio_codigo, nombre_comercio, categoria FROM b_comercios0
UNION ALL SELECT comercio_codigo, nombre_comercio, categoria FROM b_comercios0 WHERE _k = 20""")

# silver --------------------------------------------------------------------
_bd = pdate("fecha_nacimiento")
cte("s_clientes0", ["b_clientes"], f"""
SELECT trim(cliente_id) AS cliente_id, {digits('cedula')} AS cedula,
  {_bd} AS _birth, {title('ciudad')} AS ciudad,
  CASE WHEN ({null_word('canal_adquisicion')}) IS NOT NULL THEN {code('canal_adquisicion')} END AS canal_adquisicion,
  {code('estado_cuenta')} AS estado_cuenta, {pdate('fecha_registro')} AS fecha_registro
FROM (SELECT DISTINCT * FROM b_clientes)""")
_ok = f"(_birth IS NOT NULL AND {age('_birth')} >= 18 AND {age('_birth')} <= 100)"
cte("s_clientes", ["s_clientes0"], f"""
SELECT cliente_id, cedula, CASE WHEN {_ok} THEN _birth END AS fecha_nacimiento, ciudad, canal_adquisicion,
  estado_cuenta, fecha_registro, {_ok} AS fecha_nacimiento_valida, CASE WHEN {_ok} THEN {age('_birth')} END AS edad,
  count(*) OVER (PARTITION BY cedula) > 1 AS cedula_duplicada
FROM s_clientes0""")
cte("s_keys", ["s_clientes"], "SELECT DISTINCT cliente_id AS _key FROM s_clientes")
_tipo = code("tipo")
cte("s_tarjetas_all", ["b_tarjetas", "s_keys"], f"""
SELECT t.*, fecha_activacion IS NOT NULL AND tipo = 'fisica' AS fisica_activada,
  {ddiff('fecha_activacion', 'fecha_emision')} AS dias_hasta_activacion,
  CASE WHEN k._key IS NULL THEN 'cliente_id_huerfano' END AS motivo_descarte
FROM (SELECT trim(tarjeta_id) AS tarjeta_id, trim(cliente_id) AS cliente_id,
        CASE {_tipo} WHEN 'f' THEN 'fisica' WHEN 'v' THEN 'virtual' ELSE {_tipo} END AS tipo,
        {pdate('fecha_emision')} AS fecha_emision, {pdate('fecha_activacion')} AS fecha_activacion, estado_codigo
      FROM (SELECT DISTINCT * FROM b_tarjetas)) t
LEFT JOIN s_keys k ON t.cliente_id = k._key""")
cte("s_tarjetas", ["s_tarjetas_all"], "SELECT * EXCLUDE (motivo_descarte) FROM s_tarjetas_all WHERE motivo_descarte IS NULL")
cte("s_transacciones_all", ["b_transacciones", "s_keys"], f"""
SELECT t.*, CASE WHEN k._key IS NULL THEN 'cliente_id_huerfano'
                 WHEN t.monto < 0 THEN 'monto_negativo_invalido' END AS motivo_descarte
FROM (SELECT trim(transaccion_id) AS transaccion_id, trim(cliente_id) AS cliente_id, {pdate('fecha')} AS fecha,
        {code('tipo_transaccion')} AS tipo_transaccion, {money('monto')} AS monto,
        trim(comercio_codigo) AS comercio_codigo, {boolean('es_devolucion')} AS es_devolucion
      FROM (SELECT DISTINCT * FROM b_transacciones)) t
LEFT JOIN s_keys k ON t.cliente_id = k._key""")
cte("s_transacciones", ["s_transacciones_all"],
    "SELECT * EXCLUDE (motivo_descarte) FROM s_transacciones_all WHERE motivo_descarte IS NULL")
cte("s_marketing_all", ["b_marketing", "s_keys"], f"""
SELECT t.*, CASE WHEN k._key IS NULL THEN 'cliente_id_huerfano' END AS motivo_descarte
FROM (SELECT trim(interaccion_id) AS interaccion_id, trim(cliente_id) AS cliente_id, {title('campana')} AS campana,
        {pdate('fecha_contacto')} AS fecha_contacto, {code('canal')} AS canal, {boolean('respondio')} AS respondio
      FROM (SELECT DISTINCT * FROM b_marketing)) t
LEFT JOIN s_keys k ON t.cliente_id = k._key""")
cte("s_marketing", ["s_marketing_all"], "SELECT * EXCLUDE (motivo_descarte) FROM s_marketing_all WHERE motivo_descarte IS NULL")
cte("s_comercios", ["b_comercios"], f"""
SELECT trim(comercio_codigo) AS comercio_codigo, nombre_comercio, {cat_map('nombre_comercio', 'categoria')} AS categoria
FROM (SELECT DISTINCT * FROM b_comercios)""")


def _bigint_count_if(sql: str) -> str:
    """``count_if(x)`` is HUGEINT in DuckDB; ``count(*) FILTER (WHERE x)`` is BIGINT like Spark's count_if."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = _bigint_count_if(sql[j + len(key):k - 1])
        out.append(sql[i:j] + f"count(*) FILTER (WHERE {inner})")
        i = k


def sql_for(deps: list[str], select: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    if not order:
        return _bigint_count_if(select.strip())
    withs = ",\n".join(f"{n} AS ({CTES[n][1].strip()})" for n in order)
    return _bigint_count_if(f"WITH {withs}\n{select.strip()}")


# gold ----------------------------------------------------------------------
GOLD_TYPES = ["cash_in", "cash_out", "p2p_in", "p2p_out", "compra_tarjeta", "recarga_celular", "pago_servicio",
              "remesa"]
cte("g_cards", ["s_tarjetas"], """
SELECT cliente_id, max(tipo = 'fisica') AS tiene_tarjeta_fisica,
  max(coalesce(fisica_activada, FALSE)) AS fisica_activada,
  min(CASE WHEN tipo = 'fisica' THEN fecha_emision END) AS fecha_emision_fisica,
  min(CASE WHEN tipo = 'fisica' THEN fecha_activacion END) AS fecha_activacion_fisica
FROM s_tarjetas GROUP BY cliente_id""")
cte("g_txc", ["s_transacciones", "s_comercios"], """
SELECT t.*, CASE WHEN t.comercio_codigo IS NOT NULL THEN coalesce(m.categoria, 'otros_no_catalogado') END
  AS categoria_comercio
FROM s_transacciones t LEFT JOIN s_comercios m ON t.comercio_codigo = m.comercio_codigo""")
_piv = ",\n  ".join(f"count_if(tipo_transaccion = '{t}') AS n_{t}" for t in GOLD_TYPES)
cte("g_tx", ["g_txc"], f"""
SELECT cliente_id, count(*) AS n_transacciones_total, CAST(sum(monto) AS DOUBLE) AS monto_total,
  round(avg(monto), 6) AS monto_promedio, min(fecha) AS primera_transaccion, max(fecha) AS ultima_transaccion,
  count(DISTINCT categoria_comercio) AS n_categorias_comercio_distintas,
  {_piv},
  count_if(tipo_transaccion = 'compra_tarjeta') / count(*) AS pct_compra_tarjeta_sobre_total
FROM g_txc GROUP BY cliente_id""")
cte("g_pre", ["s_transacciones", "g_cards"], """
SELECT t.cliente_id, count(*) AS n_transacciones_pre, CAST(sum(t.monto) AS DOUBLE) AS monto_pre
FROM s_transacciones t JOIN g_cards c ON t.cliente_id = c.cliente_id
WHERE c.fecha_activacion_fisica IS NOT NULL AND t.fecha < c.fecha_activacion_fisica GROUP BY t.cliente_id""")
cte("g_post", ["s_transacciones", "g_cards"], """
SELECT t.cliente_id, count(*) AS n_transacciones_post, CAST(sum(t.monto) AS DOUBLE) AS monto_post
FROM s_transacciones t JOIN g_cards c ON t.cliente_id = c.cliente_id
WHERE c.fecha_activacion_fisica IS NOT NULL AND t.fecha >= c.fecha_activacion_fisica GROUP BY t.cliente_id""")
cte("g_prepost", ["g_pre", "g_post"], """
SELECT coalesce(a.cliente_id, b.cliente_id) AS cliente_id, a.n_transacciones_pre, a.monto_pre,
  b.n_transacciones_post, b.monto_post
FROM g_pre a FULL OUTER JOIN g_post b ON a.cliente_id = b.cliente_id""")
cte("g_pe", ["g_txc", "g_cards"], """
SELECT t.cliente_id, count(*) AS n_transacciones_pre_emision, CAST(sum(t.monto) AS DOUBLE) AS monto_pre_emision,
  CAST(sum(CASE WHEN t.tipo_transaccion = 'compra_tarjeta' THEN 1 ELSE 0 END) AS BIGINT) AS n_compra_tarjeta_pre_emision,
  count(DISTINCT t.categoria_comercio) AS n_categorias_comercio_pre_emision
FROM g_txc t JOIN g_cards c ON t.cliente_id = c.cliente_id
WHERE c.fecha_emision_fisica IS NOT NULL AND t.fecha < c.fecha_emision_fisica GROUP BY t.cliente_id""")
cte("g_mk", ["s_marketing"], """
SELECT cliente_id, count(*) AS n_interacciones_marketing, count(DISTINCT campana) AS n_campanas_distintas,
  avg(CAST(respondio AS INTEGER)) AS tasa_respuesta, max(fecha_contacto) AS ultima_interaccion_marketing
FROM s_marketing GROUP BY cliente_id""")
cte("g_mkpe", ["s_marketing", "g_cards"], """
SELECT m.cliente_id, count(*) AS n_interacciones_pre_emision,
  avg(CAST(m.respondio AS INTEGER)) AS tasa_respuesta_pre_emision
FROM s_marketing m JOIN g_cards c ON m.cliente_id = c.cliente_id
WHERE c.fecha_emision_fisica IS NOT NULL AND m.fecha_contacto < c.fecha_emision_fisica GROUP BY m.cliente_id""")
_z = lambda c: f"coalesce({c}, 0) AS {c}"
cte("g_join", ["s_clientes", "g_cards", "g_tx", "g_prepost", "g_pe", "g_mk", "g_mkpe"], f"""
SELECT cl.cliente_id, cl.cedula, cl.fecha_nacimiento, cl.ciudad, cl.canal_adquisicion, cl.estado_cuenta,
  cl.fecha_registro, cl.fecha_nacimiento_valida, cl.edad, cl.cedula_duplicada,
  coalesce(c.tiene_tarjeta_fisica, FALSE) AS tiene_tarjeta_fisica, coalesce(c.fisica_activada, FALSE) AS fisica_activada,
  c.fecha_emision_fisica, c.fecha_activacion_fisica, c.cliente_id IS NOT NULL AS tiene_alguna_tarjeta,
  {_z('n_transacciones_total')}, tx.monto_total, tx.monto_promedio, tx.primera_transaccion, tx.ultima_transaccion,
  {_z('n_categorias_comercio_distintas')}, {', '.join(_z('n_' + t) for t in GOLD_TYPES)},
  tx.pct_compra_tarjeta_sobre_total,
  {_z('n_transacciones_pre')}, pp.monto_pre, {_z('n_transacciones_post')}, pp.monto_post,
  {_z('n_transacciones_pre_emision')}, pe.monto_pre_emision, {_z('n_compra_tarjeta_pre_emision')},
  {_z('n_categorias_comercio_pre_emision')},
  {_z('n_interacciones_marketing')}, {_z('n_campanas_distintas')}, mk.tasa_respuesta, mk.ultima_interaccion_marketing,
  {_z('n_interacciones_pre_emision')}, mp.tasa_respuesta_pre_emision
FROM s_clientes cl
LEFT JOIN g_cards c ON cl.cliente_id = c.cliente_id
LEFT JOIN g_tx tx ON cl.cliente_id = tx.cliente_id
LEFT JOIN g_prepost pp ON cl.cliente_id = pp.cliente_id
LEFT JOIN g_pe pe ON cl.cliente_id = pe.cliente_id
LEFT JOIN g_mk mk ON cl.cliente_id = mk.cliente_id
LEFT JOIN g_mkpe mp ON cl.cliente_id = mp.cliente_id""")
_hoy = f"DATE '{P.as_of}'"
cte("g_360a", ["g_join"], f"""
SELECT *,
  CASE WHEN fisica_activada THEN 'fisica_activa' WHEN tiene_tarjeta_fisica THEN 'fisica_no_activa'
       WHEN tiene_alguna_tarjeta THEN 'solo_virtual' ELSE 'sin_tarjeta_registrada' END AS grupo_piloto,
  {ddiff('fecha_activacion_fisica', 'fecha_emision_fisica')} AS dias_hasta_activacion,
  {ddiff(_hoy, 'fecha_registro')} AS antiguedad_dias,
  {ddiff(_hoy, 'ultima_transaccion')} AS dias_desde_ultima_transaccion,
  {ddiff('fecha_activacion_fisica', 'fecha_registro')} AS dias_pre,
  {ddiff(_hoy, 'fecha_activacion_fisica')} AS dias_post,
  {ddiff(_hoy, 'ultima_interaccion_marketing')} AS dias_desde_ultima_interaccion_marketing,
  {ddiff('fecha_emision_fisica', 'fecha_registro')} AS dias_pre_emision,
  CASE WHEN n_transacciones_pre_emision > 0 THEN n_compra_tarjeta_pre_emision / n_transacciones_pre_emision END
    AS pct_compra_tarjeta_pre_emision
FROM g_join""")
cte("g_360b", ["g_360a"], f"""
SELECT *,
  {rate('n_transacciones_total', 'antiguedad_dias')} AS frecuencia_mensual,
  {rate('monto_total', 'antiguedad_dias')} AS monto_mensual,
  {rate('n_transacciones_pre', 'dias_pre')} AS frecuencia_mensual_pre,
  {rate('n_transacciones_post', 'dias_post')} AS frecuencia_mensual_post,
  {rate('monto_pre', 'dias_pre')} AS monto_mensual_pre,
  {rate('monto_post', 'dias_post')} AS monto_mensual_post,
  {rate('n_transacciones_pre_emision', 'dias_pre_emision')} AS frecuencia_mensual_pre_emision,
  {rate('monto_pre_emision', 'dias_pre_emision')} AS monto_mensual_pre_emision
FROM g_360a""")
_sw = lambda out, a, b: f"CASE WHEN fecha_emision_fisica IS NOT NULL THEN {a} ELSE {b} END AS {out}"
cte("g_360", ["g_360b"], f"""
SELECT *,
  {_sw('feat_frecuencia_mensual', 'frecuencia_mensual_pre_emision', 'frecuencia_mensual')},
  {_sw('feat_monto_mensual', 'monto_mensual_pre_emision', 'monto_mensual')},
  {_sw('feat_pct_compra_tarjeta', 'pct_compra_tarjeta_pre_emision', 'pct_compra_tarjeta_sobre_total')},
  {_sw('feat_n_categorias_comercio', 'n_categorias_comercio_pre_emision', 'n_categorias_comercio_distintas')},
  {_sw('feat_n_interacciones_marketing', 'n_interacciones_pre_emision', 'n_interacciones_marketing')},
  {_sw('feat_tasa_respuesta_marketing', 'tasa_respuesta_pre_emision', 'tasa_respuesta')},
  edad AS feat_edad, CASE WHEN antiguedad_dias > 0 THEN antiguedad_dias END AS feat_antiguedad_dias,
  ciudad AS feat_ciudad, canal_adquisicion AS feat_canal_adquisicion
FROM g_360b""")
