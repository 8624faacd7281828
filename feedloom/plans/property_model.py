"""The property-insurance example: target model, feeds, answer keys, code lists, glossary.

All tables in this module are fixed values of the example.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.local import local_frame
from ..operators.quality import Rule
from ..schemas import SIMPLE_TYPES, struct, target_model

TABLE = "harmonized_property_monthly"

# Name, type, required, semantic group, examples.
TARGETS = [
    ("record_id", "BIGINT", True, "identity", ["1", "2", "3"]),
    ("reporting_year", "INT", True, "time", ["2022", "2023", "2024", "2025"]),
    ("reporting_month", "INT", True, "time", ["1", "6", "12"]),
    ("policy_number", "STRING", True, "policy", ["ES-1001-2022", "ES-5000-2024"]),
    ("risk_type", "STRING", True, "risk",
     ["Fire", "Flood", "Theft", "Water Damage", "Electrical Damage", "Liability"]),
    ("region", "STRING", True, "geography", ["Madrid", "Barcelona", "Valencia"]),
    ("distribution_channel", "STRING", True, "distribution",
     ["Agent", "Broker", "Direct", "Bancassurance", "Digital"]),
    ("net_written_premium_eur", "DOUBLE", True, "premium", ["500.0", "1200.5", "3000.0"]),
    ("gross_written_premium_eur", "DOUBLE", True, "premium", ["600.0", "1500.0", "4000.0"]),
    ("new_policies_count", "INT", True, "policy_count", ["1", "5", "12"]),
    ("renewed_policies_count", "INT", True, "policy_count", ["10", "25", "50"]),
    ("cancelled_policies_count", "INT", True, "policy_count", ["0", "1", "3"]),
    ("claims_reported_count", "INT", True, "claims", ["0", "1", "5"]),
    ("claims_paid_count", "INT", True, "claims", ["0", "1", "4"]),
    ("gross_claims_incurred_eur", "DOUBLE", True, "claims", ["200.0", "800.0", "2500.0"]),
    ("claims_reserve_eur", "DOUBLE", False, "claims", ["50.0", "200.0", "600.0"]),
    ("management_expenses_eur", "DOUBLE", True, "expenses", ["30.0", "100.0", "350.0"]),
    ("commissions_eur", "DOUBLE", True, "expenses", ["50.0", "150.0", "400.0"]),
    ("loss_ratio", "DOUBLE", False, "kpi", ["0.35", "0.65", "1.10"]),
    ("customer_segment", "STRING", True, "customer",
     ["Individual", "Small Business", "Medium Business", "Large Enterprise"]),
    ("risk_zone", "STRING", True, "risk", ["Zone A", "Zone B", "Zone C", "Zone D"]),
    ("primary_coverage", "STRING", True, "coverage", ["Building", "Contents", "Both"]),
    ("currency", "STRING", True, "monetary", ["EUR"]),
]
TARGET_NAMES = [t[0] for t in TARGETS]
MODEL = {t[0]: t[1] for t in TARGETS}
REQUIRED = [t[0] for t in TARGETS if t[2]]
CATEGORICAL = ["customer_segment", "distribution_channel", "risk_type", "risk_zone"]
ALLOWED = {t[0]: t[4] for t in TARGETS if t[0] in CATEGORICAL}

SYSTEMS = {"ES": "ES_PROPERTY_RAW", "IT": "IT_PROPERTY_RAW"}

# Feed columns with type and the target that each one feeds, in feed order.
FEED_ES = [
    ("id_registro", "BIGINT", "record_id"),
    ("anio", "INT", "reporting_year"),
    ("mes", "INT", "reporting_month"),
    ("codigo_poliza", "STRING", "policy_number"),
    ("tipo_riesgo", "STRING", "risk_type"),
    ("provincia", "STRING", "region"),
    ("canal_distribucion", "STRING", "distribution_channel"),
    ("prima_neta", "DOUBLE", "net_written_premium_eur"),
    ("prima_bruta", "DOUBLE", "gross_written_premium_eur"),
    ("num_polizas_nuevas", "INT", "new_policies_count"),
    ("num_polizas_renovadas", "INT", "renewed_policies_count"),
    ("num_polizas_canceladas", "INT", "cancelled_policies_count"),
    ("num_siniestros_declarados", "INT", "claims_reported_count"),
    ("num_siniestros_pagados", "INT", "claims_paid_count"),
    ("importe_siniestros_bruto", "DOUBLE", "gross_claims_incurred_eur"),
    ("importe_reservas", "DOUBLE", "claims_reserve_eur"),
    ("gastos_gestion", "DOUBLE", "management_expenses_eur"),
    ("comisiones", "DOUBLE", "commissions_eur"),
    ("ratio_siniestralidad", "DOUBLE", "loss_ratio"),
    ("segmento_cliente", "STRING", "customer_segment"),
    ("zona_riesgo", "STRING", "risk_zone"),
    ("cobertura_principal", "STRING", "primary_coverage"),
    ("moneda", "STRING", "currency"),
    ("fecha_carga", "TIMESTAMP", None),
]
FEED_IT = [
    ("id_riga", "BIGINT", "record_id"),
    ("anno_riferimento", "INT", "reporting_year"),
    ("mese_riferimento", "INT", "reporting_month"),
    ("codice_polizza", "STRING", "policy_number"),
    ("tipo_rischio", "STRING", "risk_type"),
    ("regione", "STRING", "region"),
    ("canale_distributivo", "STRING", "distribution_channel"),
    ("premi_netti", "DOUBLE", "net_written_premium_eur"),
    ("premi_lordi_contabilizzati", "DOUBLE", "gross_written_premium_eur"),
    ("num_polizze_nuove", "INT", "new_policies_count"),
    ("num_polizze_rinnovate", "INT", "renewed_policies_count"),
    ("num_polizze_cancellate", "INT", "cancelled_policies_count"),
    ("sinistri_denunciati", "INT", "claims_reported_count"),
    ("sinistri_pagati", "INT", "claims_paid_count"),
    ("costo_sinistri_lordo", "DOUBLE", "gross_claims_incurred_eur"),
    ("riserva_sinistri", "DOUBLE", "claims_reserve_eur"),
    ("spese_gestione", "DOUBLE", "management_expenses_eur"),
    ("provvigioni", "DOUBLE", "commissions_eur"),
    ("rapporto_sinistri_premi", "DOUBLE", "loss_ratio"),
    ("segmento_cliente", "STRING", "customer_segment"),
    ("zona_rischio", "STRING", "risk_zone"),
    ("copertura_principale", "STRING", "primary_coverage"),
    ("valuta", "STRING", "currency"),
    ("codice_agenzia_interno", "STRING", None),
]
FEEDS = {"ES": FEED_ES, "IT": FEED_IT}

# Local columns that a reviewer must decide.
MANDATORY = {
    "ES": ["id_registro", "anio", "mes", "codigo_poliza", "tipo_riesgo", "provincia", "canal_distribucion",
           "prima_neta", "prima_bruta", "num_siniestros_declarados", "num_siniestros_pagados", "segmento_cliente",
           "cobertura_principal", "moneda"],
    "IT": ["id_riga", "anno_riferimento", "mese_riferimento", "codice_polizza", "tipo_rischio", "regione",
           "canale_distributivo", "premi_netti", "premi_lordi_contabilizzati", "sinistri_denunciati",
           "sinistri_pagati", "segmento_cliente", "copertura_principale", "valuta"],
}

# Local category values and their codes.
VALUE_TERMS = {
    "ES": {
        "customer_segment": {"Particular": "Individual", "Pequeña Empresa": "Small Business",
                             "Mediana Empresa": "Medium Business", "Gran Empresa": "Large Enterprise"},
        "distribution_channel": {"Agente": "Agent", "Corredor": "Broker", "Directo": "Direct",
                                 "Bancaseguros": "Bancassurance", "Digital": "Digital"},
        "risk_type": {"Incendio": "Fire", "Inundación": "Flood", "Robo": "Theft", "Daños por Agua": "Water Damage",
                      "Responsabilidad Civil": "Liability", "Daños Eléctricos": "Electrical Damage"},
        "risk_zone": {"Zona A": "Zone A", "Zona B": "Zone B", "Zona C": "Zone C", "Zona D": "Zone D"},
    },
    "IT": {
        "customer_segment": {"Privato": "Individual", "Piccola Impresa": "Small Business",
                             "Media Impresa": "Medium Business", "Grande Impresa": "Large Enterprise"},
        "distribution_channel": {"Agente": "Agent", "Broker": "Broker", "Diretto": "Direct",
                                 "Bancassicurazione": "Bancassurance", "Digitale": "Digital"},
        "risk_type": {"Incendio": "Fire", "Alluvione": "Flood", "Furto": "Theft", "Danni Idrici": "Water Damage",
                      "Responsabilità Civile": "Liability", "Danni Elettrici": "Electrical Damage"},
        "risk_zone": {"Zona A": "Zone A", "Zona B": "Zone B", "Zona C": "Zone C", "Zona D": "Zone D"},
    },
}

# Coverage terms of the feeds; this column has no code list.
COVERAGES = {
    "ES": ["Edificio", "Contenido", "Ambos", "Responsabilidad Civil"],
    "IT": ["Edificio", "Contenuto", "Entrambi", "Responsabilità Civile"],
}

# Local name token and target name token.
GLOSSARY = [
    ("id", "id"), ("registro", "record"), ("riga", "record"), ("anio", "year"),
    ("anno", "year"), ("riferimento", "reporting"), ("mes", "month"), ("mese", "month"),
    ("codigo", "number"), ("codice", "number"), ("poliza", "policy"), ("polizza", "policy"),
    ("tipo", "type"), ("riesgo", "risk"), ("rischio", "risk"), ("provincia", "region"),
    ("regione", "region"), ("canal", "channel"), ("canale", "channel"), ("distribucion", "distribution"),
    ("distributivo", "distribution"), ("prima", "premium"), ("premi", "premium"), ("neta", "net"),
    ("netti", "net"), ("bruta", "gross"), ("lordi", "gross"), ("contabilizzati", "written"),
    ("num", "count"), ("polizas", "policies"), ("polizze", "policies"), ("nuevas", "new"),
    ("nuove", "new"), ("renovadas", "renewed"), ("rinnovate", "renewed"), ("canceladas", "cancelled"),
    ("cancellate", "cancelled"), ("siniestros", "claims"), ("sinistri", "claims"), ("declarados", "reported"),
    ("denunciati", "reported"), ("pagados", "paid"), ("pagati", "paid"), ("importe", "eur"),
    ("bruto", "gross"), ("costo", "incurred"), ("lordo", "gross"), ("reservas", "reserve"),
    ("riserva", "reserve"), ("gastos", "expenses"), ("spese", "expenses"), ("gestion", "management"),
    ("gestione", "management"), ("comisiones", "commissions"), ("provvigioni", "commissions"), ("ratio", "ratio"),
    ("rapporto", "ratio"), ("siniestralidad", "loss"), ("segmento", "segment"), ("cliente", "customer"),
    ("zona", "zone"), ("cobertura", "coverage"), ("copertura", "coverage"), ("principal", "primary"),
    ("principale", "primary"), ("moneda", "currency"), ("valuta", "currency"),
]

# The shipped row rules, as violations.
# Predicates that stop on some rows, each with another error; two of them share the part that stops.
STOPPING = {
    "cast": "cast(policy_number AS int) > 5",
    "position": "element_at(array(1, 2), if(record_id % 1000 = 1, 3, 1)) = 9",
    "overflow": "record_id % 1000 + 9223372036854774817 < 0",
    "raised": "if(record_id % 1000 = 2, raise_error('two'), false)",
    "shared_a": "10 / (claims_reported_count - 1) > 100",
    "shared_b": "10 / (claims_reported_count - 1) > 200",
}

RULES = [
    Rule(
        "numeric_premium_gross_gte_net",
        "gross_written_premium_eur < net_written_premium_eur",
        "FAILED",
        "gross_written_premium_eur >= net_written_premium_eur",
    ),
    Rule(
        "numeric_claims_paid_lte_reported",
        "claims_paid_count > claims_reported_count",
        "FAILED",
        "claims_paid_count <= claims_reported_count",
    ),
    Rule("loss_ratio_in_range", "loss_ratio < 0.0 OR loss_ratio > 2.0", "WARNING", "0 <= loss_ratio <= 2"),
]

# Row expectations per feed.
EXPECTATIONS = {
    "ES": {
        "warn": {"valid_period": "anio IS NOT NULL AND mes BETWEEN 1 AND 12"},
        "drop": {"has_premium": "prima_bruta IS NOT NULL AND prima_bruta >= 0"},
    },
    "IT": {
        "warn": {"valid_period": "anno_riferimento IS NOT NULL AND mese_riferimento BETWEEN 1 AND 12"},
        "drop": {"has_premium": "premi_lordi_contabilizzati IS NOT NULL AND premi_lordi_contabilizzati >= 0"},
    },
}


def targets(spark: SparkSession) -> DataFrame:
    return target_model(
        spark,
        TABLE,
        [
            {"name": n, "type": t, "description": n.replace("_", " "), "required": r, "semantic_group": g, "examples": e}
            for n, t, r, g, e in TARGETS
        ],
    )


def dictionary(spark: SparkSession) -> DataFrame:
    """The approved dictionary of both feeds, version v1."""
    rows = [
        (SYSTEMS[code], local, target, "SEMANTIC_TRANSLATION", "v1", True)
        for code, feed in FEEDS.items()
        for local, _, target in feed
        if target
    ]
    return local_frame(
        spark,
        rows,
        struct(
            "source_system string, local_column_name string, global_column_name string, match_type string, "
            "mapping_version string, active_flag boolean"
        ),
    )


def answer_key(spark: SparkSession) -> DataFrame:
    rows = [(SYSTEMS[code], local, target) for code, feed in FEEDS.items() for local, _, target in feed]
    return local_frame(
        spark,
        rows,
        struct(
            "source_system string, local_column_name string, expected_global_column_name string"
        ),
    )


def mandatory(spark: SparkSession) -> DataFrame:
    rows = [(SYSTEMS[code], local) for code, names in MANDATORY.items() for local in names]
    return local_frame(
        spark,
        rows,
        struct(
            "source_system string, local_column_name string"
        ),
    )


def glossary(spark: SparkSession) -> DataFrame:
    return local_frame(spark, GLOSSARY, struct("local_token string, global_token string"))


def value_glossary(spark: SparkSession) -> DataFrame:
    """(source_field, raw_value, code) of both languages, each pair once."""
    pairs = {
        (field, raw, code) for by_field in VALUE_TERMS.values() for field, terms in by_field.items()
        for raw, code in terms.items()
    }
    return local_frame(spark, sorted(pairs), struct("source_field string, raw_value string, code string"))


def value_dictionary(spark: SparkSession) -> DataFrame:
    rows = [
        (SYSTEMS[code], field, raw, value, True)
        for code, by_field in VALUE_TERMS.items()
        for field, terms in by_field.items()
        for raw, value in terms.items()
    ]
    return local_frame(
        spark,
        rows,
        struct(
            "source_system string, source_field string, raw_value string, harmonized_value string, active_flag boolean"
        ),
    )


def feed_schema(code: str) -> T.StructType:
    return T.StructType([T.StructField(n, SIMPLE_TYPES[t.lower()]) for n, t, _ in FEEDS[code]])


def _value_replies() -> list[tuple[str, str, str]]:
    """A reply per source and category column: one leaves a value out, one names a value too many, one failed."""
    out = []
    for code, fields in VALUE_TERMS.items():
        for field, terms in fields.items():
            told = dict(terms)
            if (code, field) == ("ES", "risk_type"):
                told.pop(min(told))
                told["no such value"] = "Fire"
            failed = (code, field) == ("IT", "distribution_channel")
            out.append((SYSTEMS[code], field, "sorry" if failed else f"Here: {json.dumps(told, ensure_ascii=False)}."))
    return out


VALUE_REPLIES = _value_replies()
