"""Names and types of the contract data."""

from pyspark.sql import types as T

KEY = "id_contrato"
LABEL = "inadimplente"
CLASSES = (0, 1)

# Feature names, in the order the model matrix uses.
NUMERIC_FEATURES = (
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
)
CATEGORICAL_FEATURES = ("regiao", "tipo_equipamento")

# The feature table, one row per contract.
FEATURE_TABLE = T.StructType(
    [
        T.StructField("id_contrato", T.LongType()),
        T.StructField("valor_financiado", T.DoubleType()),
        T.StructField("valor_entrada", T.DoubleType()),
        T.StructField("prazo_meses", T.LongType()),
        T.StructField("taxa_juros", T.DoubleType()),
        T.StructField("renda_anual", T.DoubleType()),
        T.StructField("score_credito", T.DoubleType()),
        T.StructField("idade_cliente", T.LongType()),
        T.StructField("regiao", T.StringType()),
        T.StructField("tipo_equipamento", T.StringType()),
        T.StructField("safra", T.LongType()),
        T.StructField("utilizacao_credito", T.DoubleType()),
        T.StructField("num_contratos_anteriores", T.LongType()),
        T.StructField("comprometimento_renda", T.DoubleType()),
        T.StructField("inadimplente", T.LongType()),
    ]
)

REQUEST = T.StructType(
    [FEATURE_TABLE[name] for name in NUMERIC_FEATURES + CATEGORICAL_FEATURES]
)
RESPONSE = T.StructType(
    [
        T.StructField("inadimplente", T.LongType()),
        T.StructField("prob", T.DoubleType()),
    ]
)
PAYLOAD = T.StructType(
    [
        T.StructField("id_contrato", T.LongType()),
        T.StructField("request", REQUEST),
        T.StructField("response", RESPONSE),
        T.StructField("modelo", T.StringType()),
        T.StructField("versao_modelo", T.StringType()),
    ]
)
