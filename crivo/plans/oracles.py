"""The registered queries in plain SQL, to check them against another engine.

Written from the definitions, not from the Spark plans: ranks are plain windows
and AUC is counted over whole groups. Rounding scales, rounds to the even whole number
and scales back, as array libraries do.
"""

_HASH = "('0x' || substr(md5('{name}|' || {key}), 1, 8))::BIGINT"


def _hash(name: str, key: str) -> str:
    return _HASH.format(name=name, key=key)


def _clip(x: str, low: str, high: str) -> str:
    return f"CASE WHEN {x} IS NULL OR isnan({x}) THEN {x} ELSE least(greatest({x}, {low}), {high}) END"


_CONTRACTS = f"""
WITH lines AS (
  SELECT l_orderkey, max(l_discount) AS d, max(l_tax) AS t FROM lineitem GROUP BY l_orderkey
), joined AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, c_acctbal, c_mktsegment, r_name,
         CASE WHEN coalesce(d, 0e0) = 0e0 THEN 0e0 ELSE d END AS d, coalesce(t, 0e0) AS t,
         (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1)::BIGINT
           AS num_contratos_anteriores
  FROM orders
  LEFT JOIN lines ON l_orderkey = o_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey
), financed AS (
  SELECT *, round_even(({_clip('o_totalprice', '20000e0', '1500000e0')}) / 1e2, 0) * 1e2 AS valor_financiado
  FROM joined
), terms AS (
  SELECT o_orderkey AS id_contrato, valor_financiado,
         round_even((valor_financiado * least(d * 4e0, 0.4e0)) / 1e2, 0) * 1e2 AS valor_entrada,
         (24 + 12 * (o_orderkey % 6))::BIGINT AS prazo_meses,
         round_even((0.6e0 + t * 20e0) * 1e2, 0) / 1e2 AS taxa_juros,
         {_clip('(c_acctbal * 20e0)', '30000e0', '2000000e0')} AS renda_anual,
         (300 + {_hash('score', 'o_orderkey')} % 601)::DOUBLE AS score_credito,
         (18 + o_custkey % 63)::BIGINT AS idade_cliente,
         r_name AS regiao, c_mktsegment AS tipo_equipamento,
         year(o_orderdate)::BIGINT AS safra,
         least(d * 8e0, 1e0) AS utilizacao_credito,
         num_contratos_anteriores
  FROM financed
), paid AS (
  SELECT *, CASE WHEN taxa_juros / 100e0 = 0 THEN (valor_financiado - valor_entrada) / prazo_meses
       ELSE (valor_financiado - valor_entrada) * (taxa_juros / 100e0)
            / (1e0 - pow(1e0 + taxa_juros / 100e0, -prazo_meses)) END AS parcela
  FROM terms
), committed AS (
  SELECT *, {_clip('(parcela / (renda_anual / 12e0))', '0e0', '3e0')} AS comprometimento FROM paid
), risky AS (
  SELECT *, -3e0 + 2.4e0 * comprometimento + 1.8e0 * utilizacao_credito
            + -0.004e0 * (score_credito - 640) + 0.15e0 * (prazo_meses / 12e0)
            + -0.2e0 * num_contratos_anteriores AS risco,
         -3e0 + 2.4e0 * comprometimento + 0e0 * utilizacao_credito
            + -0.004e0 * (score_credito - 640) + 0.15e0 * (prazo_meses / 12e0)
            + -0.2e0 * num_contratos_anteriores AS risco_fraco
  FROM committed
), contracts AS (
  SELECT *, 1e0 / (1e0 + exp(-risco)) AS prob_exata,
         round_even((1e0 / (1e0 + exp(-risco))) * 1e6, 0) / 1e6 AS prob,
         round_even((1e0 / (1e0 + exp(-risco_fraco))) * 1e6, 0) / 1e6 AS prob_sem_utilizacao,
         round_even((comprometimento) * 1e3, 0) / 1e3 AS comprometimento_renda,
         (({_hash('label', 'id_contrato')} % 1000000) / 1000000e0
            < 1e0 / (1e0 + exp(-risco)))::BIGINT AS inadimplente
  FROM risky
), split AS (
  SELECT *, row_number() OVER (PARTITION BY inadimplente
              ORDER BY {_hash('split|42', 'id_contrato')}, id_contrato)
            <= (count(*) OVER (PARTITION BY inadimplente) + 4) // 5 AS is_test
  FROM contracts
)
"""

_FEATURES = (
    "id_contrato, valor_financiado, valor_entrada, prazo_meses, taxa_juros, renda_anual, "
    "score_credito, idade_cliente, regiao, tipo_equipamento, safra, utilizacao_credito, "
    "num_contratos_anteriores, comprometimento_renda, inadimplente"
)
_NUMERIC = [
    "valor_financiado",
    "valor_entrada",
    "prazo_meses",
    "taxa_juros",
    "renda_anual",
    "score_credito",
    "idade_cliente",
    "safra",
    "utilizacao_credito",
    "num_contratos_anteriores",
    "comprometimento_renda",
]
_WHOLE_NUMBERS = {"prazo_meses", "idade_cliente", "safra", "num_contratos_anteriores"}
_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

_FLAGS = ", ".join(
    [f"coalesce(regiao = '{r}', false) AS \"regiao_{r}\"" for r in _REGIONS]
    + [
        f"coalesce(tipo_equipamento = '{s}', false) AS \"tipo_equipamento_{s}\""
        for s in _SEGMENTS
    ]
)

_LINEAGE = (
    "'modelo_inadimplencia' AS modelo, '1' AS versao_modelo, "
    "TIMESTAMP '2024-01-01 00:00:00' AS scored_at"
)

# Area under the curve per group of `stacked(grp, inadimplente, prob)`.
_AUC = """
, by_score AS (
  SELECT grp, prob, count(*) FILTER (inadimplente = 1) AS pos,
         count(*) FILTER (inadimplente = 0) AS neg
  FROM stacked GROUP BY grp, prob
), ranked AS (
  SELECT *, sum(neg) OVER (PARTITION BY grp ORDER BY prob) - neg AS below FROM by_score
), areas AS (
  SELECT grp, sum(pos)::BIGINT AS n_positive, sum(neg)::BIGINT AS n_negative,
         sum(pos * (2 * below + neg))::DOUBLE
           / nullif(2e0 * sum(pos)::DOUBLE * sum(neg)::DOUBLE, 0) AS auc
  FROM ranked GROUP BY grp
)
"""

_CONFUSION = (
    "count(*) FILTER (inadimplente = 1 AND p = 1) AS tp, "
    "count(*) FILTER (inadimplente = 0 AND p = 1) AS fp, "
    "count(*) FILTER (inadimplente = 0 AND p = 0) AS tn, "
    "count(*) FILTER (inadimplente = 1 AND p = 0) AS fn"
)
_ACCURACY_F1 = (
    "(tp + tn)::DOUBLE / (tp + fp + tn + fn)::DOUBLE AS accuracy, "
    "coalesce(2e0 * tp / nullif((2 * tp + fp + fn)::DOUBLE, 0), 0e0) AS f1"
)

_ANSWERED = f"""
, answered AS (
  SELECT * REPLACE (round_even((prob) * 1e4, 0) / 1e4 AS prob),
         (prob >= 0.5e0)::BIGINT AS classe,
         md5(id_contrato || '|1|r1') AS pid
  FROM contracts
), payloads AS (
  SELECT *, (('0x' || substr(pid, 1, 8))::BIGINT % 64)::INTEGER AS payload_bucket,
         '/lake/payloads_inferencia/payload_bucket='
           || (('0x' || substr(pid, 1, 8))::BIGINT % 64) || '/' || id_contrato || '_' || pid
           || '.json' AS payload_uri,
         strlen(to_json({{'id_contrato': id_contrato, 'request': {{{', '.join(
             f"'{c}': {c}" for c in _NUMERIC + ['regiao', 'tipo_equipamento'])}}},
             'response': {{'inadimplente': classe, 'prob': prob}},
             'modelo': 'modelo_inadimplencia', 'versao_modelo': '1'}})::VARCHAR)::BIGINT
           AS payload_bytes
  FROM answered
)
"""

# Path, type, runs that wrote the field and values in a run; the second run left
# out the region and wrote the version as a number.
_LONGS = ("prazo_meses", "idade_cliente", "safra", "num_contratos_anteriores")
_PAYLOAD_FIELDS = [
    ("", "object", 2, "docs"),
    ("id_contrato", "long", 2, "docs"),
    ("modelo", "string", 2, "docs"),
    ("payload_uri", "string", 2, "docs"),
    ("request", "object", 2, "docs"),
    ("response", "object", 2, "docs"),
    ("response.inadimplente", "long", 2, "docs"),
    ("response.prob", "double", 2, "docs"),
    ("versao_modelo", "string", 1, "docs"),
    ("request.regiao", "string", 1, "regiao"),
    ("request.tipo_equipamento", "string", 2, "tipo_equipamento"),
    *((f"request.{c}", "long" if c in _LONGS else "double", 2, c) for c in _NUMERIC),
]

_REGISTRY = """
WITH log AS (
  SELECT 'modelo_' || (user_id % 7) AS model, event_id AS seq,
         CASE event_type WHEN 'signup' THEN 'register' WHEN 'click' THEN 'set_alias'
           WHEN 'error' THEN 'delete_alias' WHEN 'view' THEN 'set_tag'
           ELSE 'set_description' END AS op,
         (props->>'$.k')::INTEGER AS k, floor(value)::INTEGER + 1 AS v,
         'user_' || user_id AS actor
  FROM events
), registry AS (
  SELECT model, seq, op, actor,
         CASE WHEN op IN ('set_alias', 'delete_alias')
                THEN CASE WHEN k % 2 = 0 THEN 'champion' ELSE 'challenger' END
              WHEN op = 'set_tag'
                THEN CASE k % 3 WHEN 0 THEN 'dominio' WHEN 1 THEN 'owner' ELSE 'projeto' END
         END AS key,
         CASE WHEN op = 'set_alias' THEN v END AS version,
         CASE WHEN op = 'register' THEN 'models/' || seq
              WHEN op IN ('set_tag', 'set_description') THEN 'v' || k END AS value
  FROM log
)
"""


# Cumulative Poisson(1.5) and Box-Muller, as the generator has them.
def _generated() -> str:
    from crivo.functions.distributions import poisson_steps

    def u(i: int) -> str:
        name = f"contrato{i // 4}|42"
        return (
            f"((('0x' || substr(md5('{name}|' || o_orderkey), {8 * (i % 4) + 1}, 8))::BIGINT"
            f" + 0.5e0) / 4294967296e0)"
        )

    def normal(i: int, mean: str, std: str) -> str:
        return (
            f"({mean} + {std} * (sqrt(-2e0 * ln(u{i})) * cos(6.283185307179586e0 * u{i + 1})))"
        )

    poisson = " ".join(
        f"WHEN u17 <= {step!r}::DOUBLE THEN {k}" for k, step in enumerate(poisson_steps(1.5))
    )
    limit = len(poisson_steps(1.5))
    return f"""
WITH drawn AS (
  SELECT o_orderkey AS id_contrato, {', '.join(f'{u(i)} AS u{i}' for i in range(23))} FROM orders
), raw AS (
  SELECT *, round_even(({_clip(f"exp({normal(4, '11.9e0', '0.6e0')})", '20000e0', '1500000e0')}) / 1e2, 0) * 1e2
           AS valor_financiado,
         (CASE WHEN u7 < 0.1e0 THEN 24 WHEN u7 < 0.3e0 THEN 36 WHEN u7 < 0.6e0 THEN 48
              WHEN u7 < 0.8e0 THEN 60 WHEN u7 < 0.9e0 THEN 72 ELSE 84 END)::BIGINT AS prazo_meses,
         round_even(({_clip(normal(8, '1.6e0', '0.4e0'), '0.6e0', '3.5e0')}) * 1e2, 0) / 1e2 AS taxa_juros,
         round_even(({_clip(f"exp({normal(2, '12.4e0', '0.55e0')})", '30000e0', '2000000e0')}) / 1e2, 0) * 1e2
           AS renda_anual,
         round_even({_clip(normal(0, '640e0', '90e0'), '300e0', '900e0')}, 0) AS score_credito,
         round_even({_clip(normal(10, '45e0', '12e0'), '18e0', '80e0')}, 0)::BIGINT
           AS idade_cliente,
         (['Sul', 'Sudeste', 'Centro-Oeste', 'Nordeste', 'Norte'])[floor(u18 * 5)::INT + 1]
           AS regiao,
         (['Trator', 'Colheitadeira', 'Pulverizador', 'Plantadeira', 'Implemento'])
           [floor(u19 * 5)::INT + 1] AS tipo_equipamento,
         (2021 + floor(u12 * 5))::BIGINT AS safra,
         round_even((list_sort([u13, u14, u15, u16])[2]) * 1e3, 0) / 1e3 AS utilizacao_credito,
         (CASE {poisson} ELSE {limit} END)::BIGINT AS num_contratos_anteriores,
         {normal(20, '0e0', '0.6e0')} AS ruido
  FROM drawn
), entered AS (
  SELECT *, round_even((valor_financiado * (0e0 + 0.4e0 * u6)) / 1e2, 0) * 1e2 AS valor_entrada FROM raw
), paid AS (
  SELECT *, (valor_financiado - valor_entrada) * (taxa_juros / 100e0)
            / (1e0 - pow(1e0 + taxa_juros / 100e0, -prazo_meses)) AS parcela
  FROM entered
), committed AS (
  SELECT *, {_clip('(parcela / (renda_anual / 12e0))', '0e0', '3e0')} AS comprometimento FROM paid
)
SELECT id_contrato, valor_financiado, valor_entrada, prazo_meses, taxa_juros, renda_anual,
       score_credito, idade_cliente, regiao, tipo_equipamento, safra, utilizacao_credito,
       num_contratos_anteriores, round_even((comprometimento) * 1e3, 0) / 1e3 AS comprometimento_renda,
       (u22 < 1e0 / (1e0 + exp(-(-3e0 + 2.4e0 * comprometimento + 1.8e0 * utilizacao_credito
            + -0.004e0 * (score_credito - 640) + 0.15e0 * (prazo_meses / 12e0)
            + -0.2e0 * num_contratos_anteriores + ruido))))::BIGINT AS inadimplente
FROM committed
"""


def _contracts(select: str) -> str:
    return _CONTRACTS + select


def oracle_sql() -> dict[str, str]:
    matrix = ", ".join(
        [f"{c}::DOUBLE AS {c}" for c in _NUMERIC]
        + [_FLAGS, 'false AS "regiao_OCEANIA"']
    )
    signature_rows = ", ".join(
        f"({i}, '{c}', '{'long' if c in _WHOLE_NUMBERS else 'double'}')"
        for i, c in enumerate(_NUMERIC)
    )
    feature_types = {c: "bigint" for c in ("id_contrato", "inadimplente", *_WHOLE_NUMBERS)} | {
        "regiao": "string",
        "tipo_equipamento": "string",
    }
    report = " UNION ALL ".join(
        f"SELECT {i}::BIGINT AS pos, '{c}' AS name, '{feature_types.get(c, 'double')}' AS type,"
        f" count({c}) AS n_values FROM contracts"
        for i, c in enumerate(_FEATURES.split(", "))
    )
    promotion_pairs = """
, stacked AS (
  SELECT 'challenger_weaker' || '|' || a AS grp, inadimplente, p AS prob FROM (
    SELECT inadimplente, unnest(['champion', 'challenger']) AS a,
           unnest([prob, prob_sem_utilizacao]) AS p FROM split WHERE is_test)
  UNION ALL
  SELECT 'challenger_better' || '|' || a, inadimplente, p FROM (
    SELECT inadimplente, unnest(['champion', 'challenger']) AS a,
           unnest([prob_sem_utilizacao, prob]) AS p FROM split WHERE is_test)
  UNION ALL
  SELECT 'tie' || '|' || a, inadimplente, p FROM (
    SELECT inadimplente, unnest(['champion', 'challenger']) AS a,
           unnest([prob, prob]) AS p FROM split WHERE is_test)
)
"""
    stacked_two = """
, stacked AS (
  SELECT a AS grp, inadimplente, p AS prob FROM (
    SELECT inadimplente, unnest(['champion', 'challenger']) AS a,
           unnest([prob, prob_sem_utilizacao]) AS p FROM split WHERE is_test)
)
"""
    references = (
        "payload_uri, id_contrato AS id_contrato_trace, payload_bytes FROM payloads"
    )
    return {
        "scan_features": _contracts(f"SELECT {_FEATURES} FROM contracts"),
        "feature_table_roundtrip": _contracts(
            "SELECT id_contrato, valor_financiado - valor_entrada AS saldo, regiao, inadimplente"
            " FROM contracts"
        ),
        "schema_report": _contracts(report),
        "gen_contracts": _generated(),
        "clip_round": f"""
SELECT l_orderkey, l_linenumber,
       {_clip('l_extendedprice', '5000e0', '60000e0')} AS clipped,
       round_even((l_extendedprice) / 1e2, 0) * 1e2 AS hundreds, round_even(l_extendedprice, 0) AS whole,
       round_even((l_quantity / 7e0) * 1e2, 0) / 1e2 AS cents, round_even((l_quantity / 7e0) * 1e3, 0) / 1e3 AS mills
FROM lineitem""",
        "instalment": _contracts(
            "SELECT id_contrato, round_even((parcela) * 1e2, 0) / 1e2 AS parcela FROM contracts"
        ),
        "commitment_ratio": _contracts(
            "SELECT id_contrato, round_even((comprometimento) * 1e9, 0) / 1e9 AS comprometimento,"
            " comprometimento_renda FROM contracts"
        ),
        "risk_score": _contracts(
            "SELECT id_contrato, round_even((risco) * 1e9, 0) / 1e9 AS risco, prob FROM contracts"
        ),
        "default_label": _contracts("SELECT id_contrato, inadimplente FROM contracts"),
        "threshold_class": _contracts(
            "SELECT id_contrato, (prob >= 0.5e0)::INTEGER AS classe_limiar,"
            " (prob > 0.5e0)::INTEGER AS classe_modelo FROM contracts"
        ),
        "category_vocabulary": _contracts("""
, pairs AS (
  SELECT 'regiao' AS "column", regiao AS value FROM contracts
  UNION ALL SELECT 'tipo_equipamento', tipo_equipamento FROM contracts
)
SELECT "column", (row_number() OVER (PARTITION BY "column" ORDER BY value) - 1)::BIGINT AS pos,
       value, count(*) AS n
FROM pairs WHERE value IS NOT NULL GROUP BY "column", value"""),
        "one_hot": _contracts(f"SELECT id_contrato, {_FLAGS} FROM contracts"),
        "model_signature": _contracts(f"""
, names AS (
  SELECT 0 AS part, 'regiao_' || regiao AS name FROM contracts GROUP BY ALL
  UNION ALL SELECT 1, 'tipo_equipamento_' || tipo_equipamento FROM contracts GROUP BY ALL
)
SELECT pos::INTEGER AS pos, name, type FROM (VALUES {signature_rows}) s(pos, name, type)
UNION ALL
SELECT (10 + row_number() OVER (ORDER BY part, name))::INTEGER, name, 'boolean' FROM names"""),
        "align_signature": _contracts(f"SELECT id_contrato, {matrix} FROM contracts"),
        "stratified_split": _contracts("SELECT id_contrato, inadimplente, is_test FROM split"),
        "split_report": _contracts(
            "SELECT is_test, count(*) AS n_rows, sum(inadimplente)::BIGINT AS n_positive,"
            " 21 AS n_features FROM split GROUP BY is_test"
        ),
        "class_weights": _contracts("""
, sizes AS (SELECT inadimplente, count(*) AS n_class FROM contracts GROUP BY 1)
SELECT inadimplente, n_class,
       (sum(n_class) OVER ())::DOUBLE / (count(*) OVER () * n_class)::DOUBLE AS weight
FROM sizes"""),
        "auc": _contracts(
            ", stacked AS (SELECT 0 AS grp, inadimplente, prob FROM contracts)"
            + _AUC
            + "SELECT n_positive, n_negative, auc FROM areas"
        ),
        "confusion_counts": _contracts(
            f"SELECT {_CONFUSION} FROM (SELECT *, (prob >= 0.5e0)::INT AS p FROM contracts)"
        ),
        "classification_metrics": _contracts(
            f"SELECT {_ACCURACY_F1} FROM (SELECT {_CONFUSION}"
            " FROM (SELECT *, (prob >= 0.5e0)::INT AS p FROM contracts))"
        ),
        "default_rate": _contracts(
            "SELECT count(*) AS n_rows, sum(inadimplente)::BIGINT AS n_default,"
            " sum(inadimplente)::DOUBLE / count(*) AS default_rate FROM contracts"
        ),
        "run_metrics": _contracts(
            stacked_two
            + _AUC
            + f""", classed AS (
  SELECT grp, {_ACCURACY_F1} FROM (
    SELECT grp, {_CONFUSION} FROM (SELECT *, (prob >= 0.5e0)::INT AS p FROM stacked) GROUP BY grp)
)
SELECT 'run_' || grp AS run_id, grp AS run_name, unnest(['auc', 'accuracy', 'f1']) AS key,
       unnest([auc, accuracy, f1]) AS value
FROM areas JOIN classed USING (grp)"""
        ),
        "registry_versions": _REGISTRY
        + """
SELECT model, (row_number() OVER (PARTITION BY model ORDER BY seq))::INTEGER AS version,
       value AS path, actor, seq
FROM registry WHERE op = 'register'""",
        "registry_aliases": _REGISTRY
        + """
, latest AS (
  SELECT *, row_number() OVER (PARTITION BY model, key ORDER BY seq DESC) AS rn
  FROM registry WHERE op IN ('set_alias', 'delete_alias')
)
SELECT model, key AS alias, version FROM latest WHERE rn = 1 AND op = 'set_alias'""",
        "registry_paths": _REGISTRY
        + """
, latest AS (
  SELECT *, row_number() OVER (PARTITION BY model, key ORDER BY seq DESC) AS rn
  FROM registry WHERE op IN ('set_alias', 'delete_alias')
), versions AS (
  SELECT model, value AS path, row_number() OVER (PARTITION BY model ORDER BY seq)::INTEGER AS version
  FROM registry WHERE op = 'register'
)
SELECT a.model, a.key AS alias, a.version, v.path
FROM latest a LEFT JOIN versions v ON v.model = a.model AND v.version = a.version
WHERE rn = 1 AND op = 'set_alias'""",
        "registry_metadata": _REGISTRY
        + """
, latest AS (
  SELECT model, CASE op WHEN 'set_tag' THEN 'tag' ELSE 'description' END AS kind,
         coalesce(key, '') AS key, value,
         row_number() OVER (PARTITION BY model, op, key ORDER BY seq DESC) AS rn
  FROM registry WHERE op IN ('set_tag', 'set_description')
)
SELECT model, kind, key, value FROM latest WHERE rn = 1""",
        "champion_vs_challenger": _contracts(
            stacked_two + _AUC + "SELECT grp AS alias, n_positive, n_negative, auc FROM areas"
        ),
        "promotion_decision": _contracts(
            promotion_pairs
            + _AUC
            + """, sides AS (
  SELECT split_part(grp, '|', 1) AS comparison,
         max(auc) FILTER (grp LIKE '%|champion') AS auc_champion,
         max(auc) FILTER (grp LIKE '%|challenger') AS auc_challenger
  FROM areas GROUP BY 1
)
SELECT comparison, auc_champion, auc_challenger,
       CASE WHEN auc_challenger > auc_champion THEN 'promoted' ELSE 'kept' END AS decision
FROM sides"""
        ),
        "score_with_lineage": _contracts(
            f"SELECT id_contrato, (prob > 0.5e0)::INTEGER AS predicao_inadimplente, {_LINEAGE}"
            " FROM contracts"
        ),
        "score_batch_proba": _contracts(
            "SELECT id_contrato, (prob >= 0.5e0)::INTEGER AS predicao_inadimplente,"
            f" round_even((prob) * 1e4, 0) / 1e4 AS prob_inadimplencia, {_LINEAGE} FROM contracts"
        ),
        "predictions_table": _contracts(
            f"SELECT id_contrato, (prob > 0.5e0)::INTEGER AS predicao_inadimplente, {_LINEAGE}"
            " FROM contracts"
        ),
        "prediction_distribution": _contracts(
            "SELECT (prob > 0.5e0)::INTEGER AS predicao_inadimplente, count(*) AS n"
            " FROM contracts GROUP BY 1 ORDER BY 1"
        ),
        "sample_contracts": _contracts(
            f"SELECT {_FEATURES} FROM contracts ORDER BY id_contrato LIMIT 10"
        ),
        "score_sample": _contracts(
            "SELECT id_contrato, (prob >= 0.5e0)::BIGINT AS inadimplente,"
            " round_even((prob) * 1e4, 0) / 1e4 AS prob FROM contracts ORDER BY id_contrato LIMIT 5"
        ),
        "trace_spans": _contracts(
            _ANSWERED
            + """
SELECT md5(id_contrato || '|1|r1|scoring_payload_governado') AS trace_id,
       'scoring_payload_governado' AS name, id_contrato,
       'modelo_inadimplencia' AS modelo, '1' AS versao_modelo,
       id_contrato::VARCHAR AS id_texto, payload_bytes::VARCHAR AS bytes_texto, payload_uri,
       classe AS inadimplente, prob, TIMESTAMP '2024-01-01 00:00:00' AS start_time
FROM payloads"""
        ),
        "trace_tables": _contracts(
            "SELECT 'traces_inferencia_otel_spans' AS table_name, count(*) AS n_spans"
            " FROM contracts"
        ),
        "span_count": "SELECT count(*) AS n_spans FROM events",
        "span_refs": _contracts(_ANSWERED + f"SELECT {references}"),
        "span_refs_json": """
SELECT event_id, event_type AS name, props->>'$.k' AS from_map, props->>'$.k' AS from_json
FROM events""",
        "uri_normalise": r"""
SELECT page_id, '/lake/pasta a+b%/' || page_id || '.json' AS from_file,
       '/lake/pasta a+b%/' || page_id || '.json' AS from_listing,
       '/Volumes/lake/' || page_id || '.json' AS from_volume,
       's3a://bucket/' || page_id || '.json' AS from_store,
       regexp_replace(url, '^(file|dbfs):/+', '/') AS from_page
FROM pages""",
        "payload_write": _contracts(
            _ANSWERED
            + f"""
SELECT id_contrato, {', '.join(_NUMERIC)}, regiao, tipo_equipamento,
       classe AS inadimplente, prob, 'modelo_inadimplencia' AS modelo, '1' AS versao_modelo,
       payload_uri, payload_bucket
FROM payloads"""
        ),
        "payload_read": _contracts(
            _ANSWERED
            + """
SELECT payload_bucket, count(*) AS n_payloads, 0::BIGINT AS n_corrupt,
       sum(classe)::BIGINT AS n_default
FROM payloads GROUP BY payload_bucket"""
        ),
        "payload_provenance": _contracts(
            _ANSWERED
            + """
SELECT payload_bucket AS bucket_of_file, payload_bucket AS bucket_of_uri, count(*) AS n
FROM payloads GROUP BY payload_bucket"""
        ),
        "payload_folders": _contracts(
            _ANSWERED
            + """
SELECT payload_bucket, sum(payload_bytes + strlen(payload_uri) + 18)::BIGINT AS n_bytes
FROM payloads GROUP BY payload_bucket"""
        ),
        "payload_by_uri": _contracts(
            _ANSWERED
            + """
SELECT payload_uri, id_contrato, classe AS inadimplente, prob, payload_bytes
FROM payloads ORDER BY id_contrato LIMIT 5"""
        ),
        "payload_schema": _contracts(
            _ANSWERED
            + f"""
, fields(path, type, runs, n) AS (
  SELECT unnest([{', '.join(
      f"{{'path': '{path}', 'type': '{kind}', 'runs': {runs}, 'n': {n}}}"
      for path, kind, runs, n in _PAYLOAD_FIELDS
  )}], recursive := true) FROM (SELECT count(*) AS docs, {', '.join(
      f"count({c}) AS {c}" for c in _NUMERIC + ['regiao', 'tipo_equipamento']
  )} FROM payloads)
), docs AS (SELECT count(*) AS docs FROM payloads)
SELECT path, CASE WHEN path = 'versao_modelo' OR type = 'null' THEN 'string' ELSE type END AS type,
       path = 'versao_modelo' AS conflict,
       CASE WHEN path = 'versao_modelo' THEN docs WHEN type = 'long' THEN runs * n ELSE 0 END AS n_long,
       CASE WHEN type = 'double' THEN runs * n ELSE 0 END AS n_double,
       CASE WHEN type = 'string' THEN runs * n ELSE 0 END AS n_string,
       0::BIGINT AS n_boolean,
       CASE WHEN type = 'object' THEN runs * n ELSE 0 END AS n_object,
       0::BIGINT AS n_array,
       runs * (docs - n) AS n_null,
       0::BIGINT AS n_corrupt
FROM fields, docs"""
        ),
        "payload_lookup": _contracts(
            _ANSWERED
            + """
SELECT payload_uri, id_contrato, classe AS inadimplente, prob, comprometimento_renda,
       payload_bytes, true AS same_after_rebuild
FROM payloads"""
        ),
        "audit_join": _contracts(
            _ANSWERED
            + """
SELECT id_contrato::VARCHAR AS id_contrato, '1' AS versao_modelo, payload_bytes,
       classe::VARCHAR AS inadimplente, prob, payload_uri
FROM payloads"""
        ),
        "audit_orphans": _contracts(
            _ANSWERED
            + """
, unstored AS (SELECT user_id, md5(user_id || '|1|r2') AS pid FROM events)
SELECT 'span_without_payload' AS kind, '/lake/payloads_inferencia/payload_bucket='
       || (('0x' || substr(pid, 1, 8))::BIGINT % 64) || '/' || user_id || '_' || pid || '.json' AS payload_uri
FROM unstored
UNION ALL
SELECT 'payload_without_span', payload_uri FROM payloads
ANTI JOIN (SELECT l_orderkey AS id_contrato FROM lineitem) USING (id_contrato)"""
        ),
    }
