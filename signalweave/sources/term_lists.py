"""Query terms of the two instrument categories and the context words they are combined with."""

# Fixed values.
MARKET_TERMS = (
    "fuel subsidies", "split incentives", "fiscal", "financial", "tariffs", "grants", "subsidies",
    "loans", "retirement premium", "tax relief", "taxes", "charge", "barrier removal", "renewables",
    "net metering", "economic instruments", "direct investment", "funds",
    "infrastructure investments", "procurement rules", "R&D funding", "tendering schemes",
    "market-based instruments", "GHG emissions", "allowances", "green certificates",
    "white certificates", "access", "license",
)
NONMARKET_TERMS = (
    "comparison label", "endorsement label", "regulatory Instruments", "regulation", "auditing",
    "codes", "standards", "monitoring", "obligation schemes", "mandatory requirements", "target",
    "policy support", "institutional creation", "strategic planning", "strategy", "education", "aid",
    "information provision", "performance label", "training", "qualification",
    "research and development", "research & development", "R&D", "demonstration",
    "research programme", "technology deployment", "technology diffusion", "technology development",
    "voluntary", "negotiations", "agreements", "public schemes", "commitments",
)
CONTEXT_FREE = ("GHG emissions", "green certificates", "white certificates")
# Further market queries of the first list, also without context.
FURTHER_MARKET_TERMS = ("GHG certificates", "energy certificates", "greenhouse gas certificates")
CONTEXTS = (
    "climate", "carbon", "CO2", "emission", "emissions", "renewable", "renewables", "green", "energy",
    "greenhouse gas", "GHG",
)
CONTEXT_GROUP = (
    "Climate", "Carbon", "CO2", "emission", "emissions", "renewable", "renewables", "green", "energy",
    "Greenhouse Gas", "Greenhouse Gases", "GHG",
)
