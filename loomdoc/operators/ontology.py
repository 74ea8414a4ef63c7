"""Ontology registry: domains with aliases, entity types and relations, as small tables."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import text as T

ATTRIBUTE_TYPES = ("string", "number", "date", "id", "code")


@dataclass(frozen=True)
class Domain:
    name: str
    schema_name: str = "generic_text_v1"
    weight: float = 1.0
    aliases: tuple[str, ...] = ()
    negative: tuple[str, ...] = ()
    stopwords: tuple[str, ...] = ()
    #: (type name, aliases) in order
    entities: tuple[tuple[str, tuple[str, ...]], ...] = ()
    #: (name, head, tail)
    relations: tuple[tuple[str, str, str], ...] = ()

    def __post_init__(self):
        clean = tuple(sorted({a.strip().lower() for a in self.aliases if a}))
        object.__setattr__(self, "aliases", clean)
        if both := set(clean) & {x.strip().lower() for x in self.negative}:
            raise ValueError(f"aliases and negative aliases of {self.name} share {sorted(both)}")

    def describe(self, most: int = 3) -> str:
        """A few lines for people (fixed format)."""
        entities, relations = ", ".join(n for n, _ in self.entities[:most]), ", ".join(n for n, _, _ in self.relations[:most])
        return (
            f"🔹 {self.name.upper()} — {len(self.aliases)} alias ({len(self.entities)} entidades, {len(self.relations)} relaciones)\n"
            f"  Ejemplos entidades: {entities or 'N/A'}\n"
            f"  Relaciones: {relations or 'N/A'}\n"
        )


@dataclass(frozen=True)
class Registry:
    domains: tuple[Domain, ...]
    #: domain to schema template; others get the generic one
    templates: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        names = [d.name.lower() for d in self.domains]
        if twice := {n for n in names if names.count(n) > 1}:
            raise ValueError(f"domains named twice: {sorted(twice)}")

    def get(self, name: str) -> Domain | None:
        return next((d for d in self.domains if d.name.lower() == name.lower()), None)

    def domain_table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, d.name, d.schema_name, float(d.weight), self.templates.get(d.name, "generic_text_v1"), list(d.aliases), len(d.entities), len(d.relations)) for i, d in enumerate(self.domains)]
        return spark.createDataFrame(rows, "pos int, domain string, schema_name string, weight double, template string, aliases array<string>, n_entities int, n_relations int")

    def alias_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(d.name, a) for d in self.domains for a in d.aliases], "domain string, alias string")

    def entity_table(self, spark: SparkSession) -> DataFrame:
        rows = [(d.name, i, n, sorted({a.strip().lower() for a in aliases})) for d in self.domains for i, (n, aliases) in enumerate(d.entities)]
        return spark.createDataFrame(rows, "domain string, pos int, type_name string, aliases array<string>")

    def values(self, what: str) -> str:
        """The alias or entity table as SQL VALUES."""
        text = lambda x: "'" + x.replace("'", "''") + "'"
        if what == "domains":
            return "(VALUES " + ", ".join(f"({i}, {text(d.name)}, {text(d.schema_name)}, CAST({d.weight} AS DOUBLE), {text(self.templates.get(d.name, 'generic_text_v1'))}, {len(d.entities)}, {len(d.relations)})" for i, d in enumerate(self.domains)) + ") AS t(pos, domain, schema_name, weight, template, n_entities, n_relations)"
        if what == "aliases":
            return "(VALUES " + ", ".join(f"({text(d.name)}, {text(a)})" for d in self.domains for a in d.aliases) + ") AS t(domain, alias)"
        return "(VALUES " + ", ".join(f"({text(d.name)}, {i}, {text(n)}, {text(a)})" for d in self.domains for i, (n, aliases) in enumerate(d.entities) for a in sorted(set(aliases))) + ") AS t(domain, pos, type_name, alias)"


# The default registry and the schema template of each domain.
DEFAULT = Registry(
    (
        Domain("medical", "medical_note_v1", 0.95,
            ("diagnóstico", "síntoma", "tratamiento", "terapia", "hospital", "médico", "doctor", "paciente", "prescripción", "cirugía", "fármaco", "medicina", "receta", "clínico", "enfermedad", "historial médico", "análisis clínico", "diagnosis", "symptom", "therapy", "treatment", "patient", "prescription", "surgery", "drug", "medication", "clinical trial", "medical record"),
            ("financial", "contract", "invoice", "policy", "software", "product", "order", "payment", "investment", "bank", "insurance", "agreement", "article", "press", "review", "customer", "user"),
            ("caso", "registro", "documento", "data", "study", "report", "analysis", "record", "case", "note"),
            (("Disease", ("enfermedad", "patología", "disease", "condition")), ("Symptom", ("síntoma", "signo", "symptom")), ("Drug", ("fármaco", "medicamento", "drug")), ("Patient", ("paciente", "patient"))),
            (("has_symptom", "Disease", "Symptom"), ("treated_with", "Disease", "Drug"), ("attended_by", "Patient", "Doctor"))),
        Domain("legal", "legal_contract_v1", 1.0,
            ("contrato", "cláusula", "firma", "notario", "juicio", "sentencia", "demanda", "acuerdo", "penalización", "contract", "agreement", "clause", "signature", "trial", "lawsuit", "court", "penalty", "liability", "claim", "jurisdicción", "legal", "law", "compliance"),
            ("hospital", "doctor", "disease", "stocks", "finance", "invoice"), ("documento", "registro", "caso"),
            (("Party", ("parte", "firmante", "persona", "empresa", "party")), ("Contract", ("contrato", "acuerdo", "contract")), ("Obligation", ("obligación", "responsabilidad", "duty")), ("Penalty", ("multa", "sanción", "penalty", "fine"))),
            (("binds", "Contract", "Party"), ("imposes", "Contract", "Obligation"), ("penalizes", "Obligation", "Penalty"))),
        Domain("financial", "financial_tx_v2", 1.0,
            ("finanzas", "factura", "transacción", "pago", "banco", "seguro", "mercado", "divisa", "acción", "presupuesto", "bolsa", "cotización", "exchange", "finance", "investment", "stock", "currency", "insurance", "loan", "interest", "policy", "equity", "earnings", "revenue", "ingresos", "P&L", "Margin", "ROI", "financials", "trading", "comercio", "earnings per share", "profit margin", "EPS", "Dividend", "foreign exchange", "FX", "mutual fund", "hedge fund"),
            ("hospital", "doctor", "contract", "disease"), ("monto", "total", "fecha"),
            (("Invoice", ("factura", "invoice")), ("Transaction", ("pago", "transferencia", "transaction")), ("Account", ("cuenta", "account", "bank"))),
            (("paid_by", "Transaction", "Account"), ("covered_by", "Invoice", "Policy"))),
        Domain("tech_review", "tech_review_v1", 0.9,
            ("benchmark", "reseña", "modelo", "gpu", "cpu", "latencia", "precisión", "tecnología", "hardware", "software", "review", "performance", "specs", "accuracy", "ai", "model", "technology", "data", "inference", "training", "news"),
            ("contract", "disease", "invoice"), ("comparativa", "prueba", "resultado"),
            (("Product", ("producto", "modelo", "device", "software", "hardware")), ("Metric", ("latencia", "tiempo", "fps", "precisión", "metric", "accuracy"))), (("has_metric", "Product", "Metric"),)),
        Domain("ecommerce", "ecommerce_order_v1", 1.0,
            ("carrito", "pedido", "compra", "precio", "producto", "cliente", "order", "purchase", "product", "customer", "store", "review", "seller"),
            ("hospital", "contract", "disease"), ("artículo", "comentario", "item"),
            (("Order", ("pedido", "orden", "order")), ("Product", ("producto", "item", "product")), ("Review", ("reseña", "comentario", "review"))), (("contains", "Order", "Product"), ("reviewed_by", "Product", "Review"))),
        Domain("veterinary", "veterinary_case_v1", 0.9,
            ("animal", "mascota", "veterinario", "síntoma", "tratamiento", "ganado", "pet", "vet", "cattle", "disease", "vacuna", "zoonosis"),
            ("contrato", "invoice", "court"), ("caso", "registro", "historia"),
            (("Animal", ("mascota", "animal", "pet", "dog", "cat")), ("Disease", ("enfermedad", "zoonosis", "disease")), ("Treatment", ("tratamiento", "vacuna", "treatment", "vaccine"))), (("treated_with", "Animal", "Treatment"), ("has_disease", "Animal", "Disease"))),
        Domain("geopolitical", "geopolitical_event_v1", 0.8,
            ("país", "ciudad", "estado", "frontera", "conflicto", "tratado", "country", "city", "state", "border", "conflict", "treaty", "agreement", "nación", "territorio", "guerra", "alianza", "summit"),
            ("contract", "hospital", "invoice"), ("caso", "zona", "región"),
            (("Country", ("país", "nación", "country")), ("City", ("ciudad", "municipio", "city")), ("Event", ("conflicto", "tratado", "acuerdo", "event", "summit", "war"))), (("located_in", "City", "Country"), ("involves", "Event", "Country"))),
        Domain("reviews_and_news", "review_text_v1", 0.8,
            ("review", "reseña", "comentario", "opinión", "feedback", "news", "noticia", "artículo", "prensa", "report", "headline", "calificación", "score", "rating"),
            ("contract", "disease", "invoice"), ("texto", "contenido", "nota"),
            (("Review", ("reseña", "review", "comentario")), ("NewsArticle", ("noticia", "artículo", "news"))), (("published_by", "NewsArticle", "Organization"), ("authored_by", "Review", "Person"))),
        Domain("generic", "generic_text_v1", 0.5,
            ("general", "documento", "texto", "registro", "file", "document", "record", "text"), (), ("contenido", "archivo", "formato"),
            (("Person", ("persona", "nombre", "user")), ("Organization", ("empresa", "institución", "organization")), ("Date", ("fecha", "día", "año", "date")), ("Location", ("ubicación", "ciudad", "país", "address")), ("Amount", ("monto", "precio", "valor", "amount"))), ()),
    ),
    {"legal": "legal_contract_v1", "medical": "medical_note_v1", "financial": "financial_tx_v2", "ecommerce": "ecommerce_order_v1", "identity": "identity_record_v1", "tech_review": "tech_review_v1", "veterinary": "veterinary_case_v1", "geopolitical": "geopolitical_event_v1", "reviews": "review_text_v1", "generic": "generic_text_v1"},
)

#: Languages as domains, so that the synthetic prose matches something.
SAMPLE = Registry(
    (
        Domain("en", "en_v1", 1.0, ("the", "and", "that", "for", "was", "with", "this", "are"), entities=(("Article", ("the", "this")), ("Link", ("and", "with", "for")), ("Verb", ("was", "are")))),
        Domain("fr", "fr_v1", 1.0, ("des", "les", "une", "que", "pour", "est", "qui", "par", "dans"), entities=(("Article", ("des", "les", "une")), ("Link", ("que", "qui", "pour", "par")))),
        Domain("de", "de_v1", 1.0, ("der", "die", "und", "den", "von", "das", "sich", "mit", "für", "des"), entities=(("Article", ("der", "die", "das")), ("Link", ("und", "mit", "von")))),
        Domain("es", "es_v1", 1.0, ("que", "los", "del", "las", "por", "con", "una", "para"), entities=(("Article", ("los", "las", "una")), ("Link", ("que", "por", "con")))),
        Domain("generic", "generic_text_v1", 0.5, ("general", "documento", "texto", "document", "record", "text"), entities=(("Person", ("persona", "nombre", "user")),)),
    ),
    {"en": "en_v1", "fr": "fr_v1", "de": "de_v1", "es": "es_v1", "generic": "generic_text_v1"},
)


def summary(spark: SparkSession, registry: Registry) -> DataFrame:
    d = registry.domain_table(spark)
    return d.select("domain", "schema_name", "weight", F.size("aliases").alias("n_aliases"), "n_entities", "n_relations").orderBy("domain")


def overlaps(spark: SparkSession, registry: Registry) -> DataFrame:
    """Domains (by name, first < second) and the aliases they share, joined by alias."""
    a = registry.alias_table(spark)
    b = a.select(F.col("domain").alias("other"), "alias")
    both = a.join(b, "alias").where("domain < other").groupBy("domain", "other").agg(F.count("*").alias("n_shared"), F.array_sort(F.collect_list("alias")).alias("x"))
    return both.select("domain", "other", "n_shared", F.array_join("x", "|").alias("shared"))


def cosine_vectors(spark: SparkSession, registry: Registry) -> DataFrame:
    """domain, bucket, v: mean of the aliases' hashed vectors, of length 1."""
    from .chunks import vectors

    v = vectors(registry.alias_table(spark), ["domain", "alias"], text="alias")
    mean = v.groupBy("domain", "bucket").agg(F.sum("w").alias("m"))
    length = F.sqrt(F.sum(F.col("m") * F.col("m")).over(W.partitionBy("domain")))
    return mean.select("domain", "bucket", (F.col("m") / length).alias("v"))


def registry_vectors(spark: SparkSession, registry: Registry, size: int = 4096) -> np.ndarray:
    """cosine_vectors() as an array: a row per domain, in the registry's order."""
    out, at = np.zeros((len(registry.domains), size)), {d.name: i for i, d in enumerate(registry.domains)}
    for r in cosine_vectors(spark, registry).collect():  # as many rows as the registry has words
        out[at[r["domain"]], r["bucket"]] = r["v"]
    return out


def normalized_aliases(raw: DataFrame) -> DataFrame:
    """domain, alias: lower-cased and stripped, each once, none empty, of raw aliases (domain, alias)."""
    return raw.select("domain", T.keyword(F.col("alias")).alias("alias")).where("alias <> ''").distinct()


def negative_conflicts(aliases: DataFrame, negative: DataFrame) -> DataFrame:
    """domain, alias: aliases that are also negative aliases of their domain, normalized."""
    return normalized_aliases(aliases).intersect(normalized_aliases(negative))


def named_twice(domains: DataFrame) -> DataFrame:
    """domain (lower-cased), n of domains whose names differ in case only, or not at all."""
    return domains.groupBy(F.lower("domain").alias("domain")).agg(F.count("*").alias("n")).where("n > 1")


def lookup(domains: DataFrame, name: Column) -> DataFrame:
    """Rows of domains with that name, in any case."""
    return domains.where(F.lower("domain") == F.lower(name))


def valid_vectors(vectors: DataFrame, name: str, vector: str) -> DataFrame:
    """Number of vectors, those with the first one's dimension, and the names of the rest."""
    want = vectors.agg(F.min_by(F.size(vector), name).alias("want"))
    v = vectors.select(name, F.size(vector).alias("dim")).crossJoin(F.broadcast(want))  # one row
    wrong = F.when(F.col("dim") != F.col("want"), F.col(name))
    return v.agg(F.count("*").alias("total"), F.count(F.when(F.col("dim") == F.col("want"), 1)).alias("valid"), F.array_sort(F.collect_list(wrong)).alias("invalid"), F.max("want").alias("dim"))


def keyword_f1(keywords: DataFrame, spark: SparkSession, registry: Registry, keys: list[str]) -> DataFrame:
    """keys, domain, matches, precision, recall, k: F1 of folded keywords (keys, keywords) and aliases."""
    folded = lambda c: F.filter(F.array_distinct(F.transform(c, T.folded)), lambda x: x != "")
    own = keywords.select(*keys, folded(F.col("keywords")).alias("a"))
    domains = registry.domain_table(spark).select("pos", "domain", folded(F.col("aliases")).alias("b"))
    grid = own.crossJoin(F.broadcast(domains))  # the registry's few rows beside every text
    grid = grid.withColumn("matches", F.size(F.array_intersect("a", "b")).cast("long"))
    p, r = F.col("matches") / F.greatest(F.lit(1), F.size("a")), F.col("matches") / F.greatest(F.lit(1), F.size("b"))
    return grid.select(*keys, "pos", "domain", "matches", p.alias("precision"), r.alias("recall"), F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0).alias("k"))


def entity_scores(toks: DataFrame, spark: SparkSession, registry: Registry, keys: list[str]) -> DataFrame:
    """keys, domain, type_name, score, rank: share of a type's aliases among the tokens (keys, tokens)."""
    e = registry.entity_table(spark)
    known = sorted({a.strip().lower() for d in registry.domains for _, aliases in d.entities for a in aliases})
    toks = toks.select(*keys, F.array_intersect("tokens", F.array(*map(F.lit, known)).cast("array<string>")).alias("tokens"))
    grid = toks.crossJoin(F.broadcast(e)).withColumn("score", F.size(F.array_intersect("aliases", "tokens")) / F.size("aliases"))
    rank = F.row_number().over(W.partitionBy(*keys, "domain").orderBy(F.desc("score"), "pos"))
    return grid.withColumn("rank", rank).select(*keys, "domain", "type_name", "score", "rank")
