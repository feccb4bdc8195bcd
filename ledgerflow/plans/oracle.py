"""DuckDB oracle SQL for the registered queries.

The SQL follows the naive shapes of the original jobs (split and mirror by
UNION ALL, left join plus IS NULL, window max plus equality filter), so each
check compares the Spark operator with an independent formulation.  Shared
steps are CTEs with ``{name}`` references; ``build`` resolves them together
with the fixture views into one ``WITH ... SELECT`` statement.
"""

from __future__ import annotations

import re

from ledgerflow.plans import catalog as Q
from ledgerflow.sources.fixtures import VIEWS

_REF = re.compile(r"\{(\w+)\}")

_TX_COLS = "insert_date, uuid, date, accounting_date, invoice, invoice_description, type, id_client"
_PARTS_OF = ("CAST(year({c}) AS VARCHAR) AS year, CAST(month({c}) AS VARCHAR) AS month, "
             "CAST(day({c}) AS VARCHAR) AS day")
_PADDED_PARTS_OF = ("CAST(year({c}) AS VARCHAR) AS year, "
                    "lpad(CAST(month({c}) AS VARCHAR), 2, '0') AS month, "
                    "lpad(CAST(day({c}) AS VARCHAR), 2, '0') AS day")
_LEDGER_COLS = (_TX_COLS + ", normal_correctora, amount_d, amount_c, account_id, year, month, day")
_UNMAPPED_COLS = ("insert_date, uuid, date, invoice, invoice_description, type, id_client, "
                  "amount_d, amount_c, year, month, day")
_CLIENT_COLS = "created_at, company_name, tax_id, client_id, country"
_YESTERDAY_TS = f"CAST(DATE '{Q.AS_OF}' - INTERVAL 1 DAY AS TIMESTAMP)"
_CDC_ORDER = ("seq DESC, op DESC NULLS LAST, l_quantity DESC NULLS LAST, "
              "l_extendedprice DESC NULLS LAST, change_ts DESC NULLS LAST")


def _latest_map(src: str, key: str) -> str:
    return f"""
SELECT code, posting_class, register_type, map_descr, debit_account, credit_account FROM (
  SELECT DISTINCT code, posting_class, register_type, map_descr, debit_account, credit_account, y, m, d
  FROM (SELECT *, {key} AS dn, max({key}) OVER (PARTITION BY code, posting_class) AS mx FROM {{{src}}}) t
  WHERE dn = mx) u"""


_CAL = "make_date(TRY_CAST(y AS INTEGER), TRY_CAST(m AS INTEGER), TRY_CAST(d AS INTEGER))"
_CAT = "TRY_CAST(y || m || d AS INTEGER)"


def _post(joined: str, cls: str, op: str) -> str:
    return f"""
SELECT {_TX_COLS}, amount_d, amount_c, normal_correctora, debit_account AS account_id, year, month, day
FROM {{{joined}}} WHERE amount_d {op} 0 AND normal_correctora = '{cls}'
UNION ALL
SELECT {_TX_COLS}, amount_d, amount_c, normal_correctora, credit_account AS account_id, year, month, day
FROM {{{joined}}} WHERE amount_c {op} 0 AND normal_correctora = '{cls}'"""


def _ledger_steps(suffix: str, map_cte: str) -> dict[str, str]:
    return {
        f"o_joined{suffix}": f"""
SELECT t.insert_date, t.uuid, t.date, t.accounting_date, t.invoice,
       m.map_descr AS invoice_description, t.type, t.id_client, t.amount_d, t.amount_c,
       m.posting_class AS normal_correctora, m.debit_account, m.credit_account,
       t.year, t.month, t.day
FROM {{o_mirrored}} t JOIN {{{map_cte}}} m ON t.invoice = m.code AND t.type = m.register_type""",
        f"o_normal{suffix}": _post(f"o_joined{suffix}", "Normal", ">="),
        f"o_correcting{suffix}": _post(f"o_joined{suffix}", "Correctora", "<"),
        f"o_absolute{suffix}": f"""
SELECT {_TX_COLS}, normal_correctora, abs(amount_d) AS amount_d, abs(amount_c) AS amount_c,
       account_id, year, month, day
FROM (SELECT * FROM {{o_normal{suffix}}} UNION ALL SELECT * FROM {{o_correcting{suffix}}}) p""",
        f"o_ledger{suffix}": f"""
SELECT * FROM {{o_absolute{suffix}}}
WHERE account_id NOT IN ('NA', 'NAD', 'NAC') AND account_id IS NOT NULL""",
    }


def _unmapped_steps(name: str, map_cte: str) -> dict[str, str]:
    def half(cls: str, cond: str) -> str:
        return f"""
SELECT t.* FROM {{o_tx}} t
LEFT JOIN (SELECT * FROM {{{map_cte}}} WHERE posting_class = '{cls}') m
       ON t.invoice = m.code AND t.type = m.register_type
WHERE ({cond}) AND m.code IS NULL AND m.register_type IS NULL"""
    return {name: f"""
SELECT {_UNMAPPED_COLS} FROM (
{half('Normal', 't.amount_d >= 0 OR t.amount_c >= 0')}
UNION ALL
{half('Correctora', 't.amount_d < 0 OR t.amount_c < 0')}
) u"""}


def _prepared_cdc(where: str) -> str:
    return f"""
SELECT l_orderkey, l_linenumber, change_ts, op,
       sha256('{Q.SECRET}' || CAST(l_quantity AS VARCHAR)) AS l_quantity, l_extendedprice,
       {_PADDED_PARTS_OF.format(c='change_ts')}
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_CDC_ORDER}) AS rn
      FROM (SELECT l_orderkey, l_linenumber, seq, change_ts, coalesce(op, 'C') AS op,
                   l_quantity, l_extendedprice FROM {{fx_cdc}} WHERE {where}) f
      WHERE seq IS NOT NULL) r
WHERE rn = 1"""


CTES: dict[str, str] = {
    "o_ops": f"""
SELECT insert_date, 'op-' || src_id AS uuid, biz_date AS date, acct_date AS accounting_date,
       code AS invoice, descr AS invoice_description, 'OP' AS type,
       country || '-' || CAST(contract_id AS VARCHAR) AS id_client, amount
FROM {{fx_operations}}""",
    "o_ecs": f"""
SELECT insert_date, 'ec-' || src_id AS uuid, biz_date AS date, acct_date AS accounting_date,
       code AS invoice, descr AS invoice_description, 'EC' AS type,
       country || '-' || CAST(contract_id AS VARCHAR) AS id_client, amount
FROM {{fx_concepts}}""",
    "o_conformed": "SELECT * FROM {o_ops} UNION ALL SELECT * FROM {o_ecs}",
    "o_split": f"""
SELECT {_TX_COLS}, amount AS amount_d, CAST(NULL AS DOUBLE) AS amount_c FROM {{o_conformed}} WHERE amount >= 0
UNION ALL
SELECT {_TX_COLS}, CAST(NULL AS DOUBLE) AS amount_d, amount AS amount_c FROM {{o_conformed}} WHERE amount < 0""",
    "o_tx": f"SELECT *, {_PARTS_OF.format(c='insert_date')} FROM {{o_split}}",
    "o_mirrored": f"""
SELECT {_TX_COLS}, amount_d, amount_c, year, month, day FROM {{o_tx}}
UNION ALL
SELECT {_TX_COLS}, amount_c AS amount_d, amount_d AS amount_c, year, month, day FROM {{o_tx}}""",
    "o_map": _latest_map("fx_concept_map", _CAL),
    "o_map_concat": _latest_map("fx_concept_map", _CAT),
    "o_map_v1": _latest_map("fx_concept_map_v1", _CAL),
    "o_sheet_latest": _latest_map("fx_sheet_history", _CAL),
    "o_sheet_latest_concat": _latest_map("fx_sheet_history", _CAT),
    **_ledger_steps("", "o_map"),
    **_ledger_steps("_concat", "o_map_concat"),
    **_ledger_steps("_v1", "o_map_v1"),
    **_unmapped_steps("o_unmapped", "o_map"),
    **_unmapped_steps("o_unmapped_v1", "o_map_v1"),
    "o_classified": """
SELECT *, 'Normal' AS normal_correctora FROM {o_tx} WHERE amount_d >= 0 OR amount_c >= 0
UNION ALL
SELECT *, 'Correctora' AS normal_correctora FROM {o_tx} WHERE amount_d < 0 OR amount_c < 0""",
    "o_clients": f"""
SELECT start_operation AS created_at, legal_name AS company_name, tax_id,
       country || '-' || CAST(contract_id AS VARCHAR) AS client_id, country,
       {_PARTS_OF.format(c='start_operation')}
FROM {{fx_companies}} WHERE status = '0' AND contract_id IS NOT NULL""",
    "o_prev_clients": """
SELECT client_id, legal_name AS company_name, tax_id FROM {fx_clients_prev}""",
    "o_gold_ledger": f"""
SELECT * FROM {{o_ledger}} WHERE insert_date < TIMESTAMP '{Q.GOLD_TX_BEFORE}'""",
    "o_gold_clients": f"""
SELECT * FROM {{o_clients}} WHERE created_at < TIMESTAMP '{Q.GOLD_CLIENTS_BEFORE}'""",
    "o_reprocessed": f"""
SELECT {_TX_COLS.replace('insert_date', _YESTERDAY_TS + " AS insert_date")},
       normal_correctora, amount_d, amount_c, account_id, year, month, day
FROM {{o_ledger}} l
WHERE EXISTS (SELECT 1 FROM {{o_unmapped_v1}} u WHERE u.uuid = l.uuid AND u.invoice = l.invoice)
  AND l.date > TIMESTAMP '2023-01-01 00:00:00'""",
    "o_restamped_ledger": """
SELECT * FROM {o_ledger} t
WHERE NOT EXISTS (SELECT 1 FROM {o_reprocessed} s WHERE s.uuid = t.uuid AND s.account_id = t.account_id)
UNION ALL
SELECT * FROM {o_reprocessed}""",
    "o_invoices": f"""
SELECT DISTINCT invoice, type, substring(id_client, 1, 2) AS country, normal_correctora
FROM (SELECT *, 'Normal' AS normal_correctora FROM {{o_unmapped}} WHERE amount_d >= 0 OR amount_c >= 0
      UNION ALL
      SELECT *, 'Correctora' AS normal_correctora FROM {{o_unmapped}} WHERE amount_d < 0 OR amount_c < 0) c""",
    "o_newer_tx": f"""
SELECT * FROM {{o_ledger}}
WHERE (SELECT count(*) FROM {{o_gold_ledger}}) = 0
   OR insert_date > (SELECT max(insert_date) FROM {{o_gold_ledger}})""",
    "o_newer_clients": f"""
SELECT * FROM {{o_clients}}
WHERE (SELECT count(*) FROM {{o_gold_clients}}) = 0
   OR created_at > (SELECT max(created_at) FROM {{o_gold_clients}})""",
}

_LOAD_PARTS = (f"CAST(year(DATE '{{d}}') AS VARCHAR) AS year, CAST(month(DATE '{{d}}') AS VARCHAR) AS month, "
               f"CAST(day(DATE '{{d}}') AS VARCHAR) AS day")

FINAL: dict[str, str] = {
    "scan_change_feed": "SELECT * FROM {fx_cdc}",
    "fill_op_code": """
SELECT l_orderkey, l_linenumber, seq, change_ts, coalesce(op, 'C') AS op, l_quantity, l_extendedprice
FROM {fx_cdc}""",
    "latest_by_key": """
SELECT l_orderkey, l_linenumber, change_ts, op, l_quantity, l_extendedprice
FROM (SELECT *, max(seq) OVER (PARTITION BY l_orderkey, l_linenumber) AS mx FROM {fx_cdc}) t
WHERE seq = mx""",
    "latest_by_key_one": f"""
SELECT l_orderkey, l_linenumber, change_ts, op, l_quantity, l_extendedprice
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_CDC_ORDER}) AS rn
      FROM {{fx_cdc}} WHERE seq IS NOT NULL) t
WHERE rn = 1""",
    "date_parts_padded": f"SELECT *, {_PADDED_PARTS_OF.format(c='change_ts')} FROM {{fx_cdc}}",
    "pseudonymise": f"""
SELECT country, customer_id, contract_id,
       sha256('{Q.SECRET}' || coalesce(legal_name, '')) AS legal_name,
       sha256('{Q.SECRET}' || coalesce(tax_id, '')) AS tax_id,
       status, start_operation
FROM {{fx_companies}}""",
    "ingest_changes": _prepared_cdc("TRUE"),
    "apply_changes": f"""
SELECT * FROM ({_prepared_cdc('op IS NULL')}) b
WHERE NOT EXISTS (SELECT 1 FROM ({_prepared_cdc('op IS NOT NULL')}) c
                  WHERE c.l_orderkey = b.l_orderkey AND c.l_linenumber = b.l_linenumber)
UNION ALL
SELECT * FROM ({_prepared_cdc('op IS NOT NULL')}) c WHERE op <> 'D'""",
    "apply_changes_out_of_order": f"""
SELECT l_orderkey, l_linenumber, change_ts, op, l_quantity, l_extendedprice, {_PADDED_PARTS_OF.format(c='change_ts')}
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_CDC_ORDER}) AS rn
      FROM (SELECT * REPLACE (coalesce(op, 'C') AS op) FROM {{fx_cdc_versions}}) f) t
WHERE rn = 1 AND op <> 'D'""",
    "upsert_by_key": """
SELECT * FROM {fx_upsert_target} t WHERE NOT EXISTS (SELECT 1 FROM {fx_upsert_source} s WHERE s.contract_id = t.contract_id)
UNION ALL
SELECT * FROM {fx_upsert_source}""",
    "upsert_schema_evolution": f"""
SELECT client_id, company_name, tax_id, NULL::TIMESTAMP AS created_at, NULL::VARCHAR AS country,
       NULL::VARCHAR AS year, NULL::VARCHAR AS month, NULL::VARCHAR AS day
FROM {{o_prev_clients}} t
WHERE NOT EXISTS (SELECT 1 FROM {{o_clients}} s
                  WHERE s.client_id = t.client_id AND s.created_at >= TIMESTAMP '{Q.CLIENT_HISTORY_START}')
UNION ALL
SELECT client_id, company_name, tax_id, created_at, country, year, month, day
FROM {{o_clients}} WHERE created_at >= TIMESTAMP '{Q.CLIENT_HISTORY_START}'""",
    "delete_by_key": """
SELECT * FROM {o_unmapped_v1} t WHERE NOT EXISTS (SELECT 1 FROM {o_ledger} l WHERE l.uuid = t.uuid)""",
    "date_parts": f"SELECT *, {_PARTS_OF.format(c='insert_date')} FROM {{fx_operations}}",
    "stamp_load_date": f"SELECT *, {_LOAD_PARTS.format(d=Q.AS_OF)} FROM {{fx_companies}}",
    "conform_clients": f"SELECT {_CLIENT_COLS} FROM {{o_clients}}",
    "active_clients": "SELECT * FROM {o_clients}",
    "union_regions": f"SELECT {_CLIENT_COLS} FROM {{o_clients}}",
    "conform_operations": "SELECT * FROM {o_ops}",
    "conform_concepts": "SELECT * FROM {o_ecs}",
    "sign_split": "SELECT * FROM {o_split}",
    "all_transactions": "SELECT * FROM {o_tx}",
    "mirror_entries": "SELECT * FROM {o_mirrored}",
    "map_concepts": "SELECT * FROM {o_joined}",
    "latest_snapshot": "SELECT * FROM {o_sheet_latest}",
    "latest_snapshot_concat": "SELECT * FROM {o_sheet_latest_concat}",
    "post_normal": "SELECT * FROM {o_normal}",
    "post_correcting": "SELECT * FROM {o_correcting}",
    "absolute_amounts": "SELECT * FROM {o_absolute}",
    "drop_na_accounts": "SELECT * FROM {o_ledger}",
    "post_ledger": "SELECT * FROM {o_ledger}",
    "post_ledger_concat_key": "SELECT * FROM {o_ledger_concat}",
    "classify_posting": "SELECT * FROM {o_classified}",
    "unmapped_entries": "SELECT * FROM {o_unmapped}",
    "unmapped_correcting": """
SELECT t.insert_date, t.uuid, t.date, t.invoice, t.invoice_description, t.type, t.id_client,
       t.amount_d, t.amount_c, t.year, t.month, t.day
FROM {o_tx} t LEFT JOIN (SELECT * FROM {o_map} WHERE posting_class = 'Correctora') m
       ON t.invoice = m.code AND t.type = m.register_type
WHERE (t.amount_d < 0 OR t.amount_c < 0) AND m.code IS NULL""",
    "restamp_yesterday": f"""
SELECT {_TX_COLS.replace('insert_date', _YESTERDAY_TS + " AS insert_date")},
       normal_correctora, amount_d, amount_c, account_id, year, month, day FROM {{o_ledger}}""",
    "reprocess_candidates": "SELECT * FROM {o_reprocessed}",
    "reprocess_upsert": """
SELECT * FROM {o_ledger} t
WHERE NOT EXISTS (SELECT 1 FROM {o_reprocessed} s WHERE s.uuid = t.uuid AND s.account_id = t.account_id)
UNION ALL
SELECT * FROM {o_reprocessed}""",
    "reprocess_delete": """
SELECT * FROM {o_unmapped_v1} t
WHERE NOT EXISTS (
  SELECT 1 FROM {o_unmapped_v1} u
  WHERE u.uuid = t.uuid
    AND EXISTS (SELECT 1 FROM {o_ledger} l WHERE l.uuid = u.uuid AND l.invoice = u.invoice)
    AND u.date > TIMESTAMP '2023-01-01 00:00:00')""",
    "unmapped_invoices": f"SELECT *, {_LOAD_PARTS.format(d=Q.AS_OF)} FROM {{o_invoices}}",
    "report_by_country": f"""
SELECT *, {_LOAD_PARTS.format(d=Q.AS_OF)} FROM {{o_invoices}} WHERE country IN ('MX', 'BR', 'CO')""",
    "high_water_mark": "SELECT max(insert_date) AS mark, count(*) AS n FROM {o_gold_ledger}",
    "incremental_since": "SELECT * FROM {o_newer_tx}",
    "since_yesterday": f"""
SELECT {_TX_COLS}, normal_correctora, amount_d, amount_c, account_id FROM {{o_ledger}}
WHERE insert_date >= DATE '{Q.AS_OF}' - INTERVAL 1 DAY""",
    "incoming_transactions": f"""
SELECT {_TX_COLS}, normal_correctora, amount_d, amount_c, account_id FROM (
  SELECT * FROM {{o_gold_ledger}} g
  WHERE NOT EXISTS (SELECT 1 FROM {{o_newer_tx}} n WHERE n.uuid = g.uuid AND n.account_id = g.account_id)
  UNION ALL SELECT * FROM {{o_newer_tx}}) x
WHERE insert_date >= DATE '{Q.AS_OF}' - INTERVAL 1 DAY""",
    "incoming_clients": f"""
SELECT {_CLIENT_COLS} FROM (
  SELECT * FROM {{o_gold_clients}} g
  WHERE NOT EXISTS (SELECT 1 FROM {{o_newer_clients}} n WHERE n.client_id = g.client_id)
  UNION ALL SELECT * FROM {{o_newer_clients}}) x
WHERE created_at >= DATE '{Q.CLIENTS_AS_OF}' - INTERVAL 1 DAY""",
    "changed_clients": f"""
SELECT c.created_at, c.company_name, c.tax_id, c.client_id, c.country
FROM {{o_clients}} c JOIN {{o_prev_clients}} p ON c.client_id = p.client_id
WHERE c.company_name <> p.company_name OR c.tax_id <> p.tax_id""",
    "history_clients": f"""
SELECT * FROM {{o_clients}} WHERE created_at >= TIMESTAMP '{Q.CLIENT_HISTORY_START}'""",
    "history_since": """
SELECT * FROM {o_tx} WHERE insert_date >= TIMESTAMP '2023-01-01 00:00:00.000'""",
    "newer_than_text": """
SELECT src_id, code, amount, TRY_CAST(inserted AS TIMESTAMP) AS inserted FROM {fx_text_operations}
WHERE TRY_CAST(inserted AS TIMESTAMP) > (
  SELECT max(TRY_CAST(inserted AS TIMESTAMP)) FROM {fx_text_operations}
  WHERE code = '1-URGENT' AND amount < 0 AND inserted < '1998-01-01')""",
    "history_since_text": f"""
SELECT src_id, code, amount, TRY_CAST(inserted AS TIMESTAMP) AS inserted FROM {{fx_text_operations}}
WHERE TRY_CAST(inserted AS TIMESTAMP) >= TIMESTAMP '{Q.CLIENT_HISTORY_START}'""",
    "history_transactions": """
SELECT * FROM {o_ledger} WHERE insert_date >= TIMESTAMP '2023-01-01 00:00:00.000'""",
}

_BLOCK = Q.SECRET.encode().ljust(64, b"\0")
_IPAD, _OPAD = (bytes(b ^ pad for b in _BLOCK).hex() for pad in (0x36, 0x5C))


def _mac(text: str) -> str:
    return f"'k2:' || sha256(unhex('{_OPAD}') || unhex(sha256(unhex('{_IPAD}') || encode({text}))))"


FINAL |= {
    "pseudonymise_keyed": f"""
SELECT country, {_mac("CAST(customer_id AS VARCHAR)")} AS customer_id, contract_id, {_mac("coalesce(legal_name, '')")} AS legal_name,
       {_mac("coalesce(tax_id, '')")} AS tax_id, status, start_operation
FROM {{fx_companies}}""",
    "quarantine_landing": """
SELECT CASE WHEN p_size % 10 NOT IN (1, 2, 3) THEN p_partkey END AS partkey, CASE WHEN p_size % 10 NOT IN (1, 2, 3) THEN p_brand END AS brand,
       CASE WHEN p_size % 10 NOT IN (1, 2, 3) THEN CAST(p_size AS INTEGER) END AS size,
       CASE p_size % 10 WHEN 1 THEN p_partkey || ',' || p_brand || ',' || p_size || ',more' WHEN 2 THEN p_partkey || ',' || p_brand
            WHEN 3 THEN p_partkey || ',' || p_brand || ',n' || p_size END AS bad_line
FROM part""",
    "upsert_touched_partitions": "SELECT * FROM {o_restamped_ledger}",
    "post_ledger_split": "SELECT * FROM {o_ledger}",
    "unmapped_entries_split": "SELECT * FROM {o_unmapped}",
    "incremental_since_newest_folder": """
SELECT * FROM {o_restamped_ledger} WHERE insert_date > (SELECT max(insert_date) FROM {o_gold_ledger})""",
    "delete_touched_partitions": FINAL["reprocess_delete"],
    "merge_key_buckets": FINAL["apply_changes_out_of_order"],
    "since_yesterday_pruned": f"""
SELECT {_TX_COLS}, normal_correctora, amount_d, amount_c, account_id FROM {{o_restamped_ledger}}
WHERE insert_date >= DATE '{Q.AS_OF}' - INTERVAL 1 DAY""",
    "incremental_since_pruned": """
SELECT * FROM {o_restamped_ledger} WHERE insert_date > (SELECT max(insert_date) FROM {o_gold_ledger})""",
    "history_transactions_pruned": "SELECT * FROM {o_restamped_ledger} WHERE insert_date >= TIMESTAMP '2023-01-01 00:00:00.000'",
    "incremental_ledger": f"""
SELECT * FROM {{o_ledger_v1}} t
WHERE insert_date < TIMESTAMP '{Q.GOLD_TX_BEFORE}'
  AND NOT EXISTS (SELECT 1 FROM {{o_ledger}} s WHERE s.uuid = t.uuid AND s.account_id = t.account_id)
UNION ALL
SELECT * FROM {{o_ledger}}""",
}


def build(final: str) -> str:
    """One DuckDB statement: the CTEs ``final`` needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        body = CTES.get(name) or VIEWS.get(name)
        for ref in _REF.findall(body):
            if ref in CTES or ref in VIEWS:
                visit(ref)
        order.append(name)

    for ref in _REF.findall(final):
        if ref in CTES or ref in VIEWS:
            visit(ref)
    plain = lambda text: _REF.sub(lambda m: m.group(1), text).strip()
    ctes = ",\n".join(f"{n} AS ({plain(CTES.get(n) or VIEWS[n])})" for n in order)
    return (f"WITH {ctes}\n" if ctes else "") + plain(final)


def oracle_sql() -> dict[str, str]:
    return {name: build(text) for name, text in FINAL.items() if name in Q.QUERIES}
