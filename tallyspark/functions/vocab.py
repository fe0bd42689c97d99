"""Dictionaries used by the lending-language rules.

FIXED VALUES: the lexicon, glossary and extraction dictionaries below must equal
the rules being reproduced, in this order (order decides which entry wins).
"""

# ---------------------------------------------------------------------------
# FIXED VALUES — compliance lexicon: (category, severity, alternative, phrases)
COMPLIANCE_LEXICON = [
    ("guaranteed approval", "high",
     "Таны хүсэлтийг банкны эцсийн хяналт, шаардлагын дагуу шийдвэрлэнэ.",
     ["guaranteed approval", "баталгаатай зөвшөөрнө", "заавал батална"]),
    ("final approval promise", "high",
     "Урьдчилсан мэдээлэлд үндэслэн боломжийг шалгаж байгаа бөгөөд эцсийн шийдвэр хяналтын дараа гарна.",
     ["final approval is confirmed", "эцсийн зөвшөөрөл гарсан", "зээл тань батлагдсан"]),
    ("misleading interest/fee wording", "medium",
     "Хүү, шимтгэлийн нөхцөл нь бүтээгдэхүүн, шалгуур болон гэрээний нөхцлөөс хамаарна.",
     ["no fees", "no hidden fees", "0% interest", "hidden fee байхгүй", "хүү шимтгэлгүй", "хамгийн бага хүүтэй"]),
    ("missing final review disclaimer", "medium",
     "Энэ нь урьдчилсан үнэлгээ бөгөөд эцсийн шийдвэрийг нэмэлт хяналтын дараа гаргана.",
     ["pre-approved", "урьдчилан зөвшөөрөгдсөн"]),
    ("unsafe rejection explanations", "high",
     "Одоогийн мэдээллээр хүсэлтийг үргэлжлүүлэх боломжгүй байна. Дэлгэрэнгүй шалтгааныг албан ёсны сувгаар тайлбарлана.",
     ["blacklisted", "та муу зээлдэгч", "you are a bad borrower"]),
]
ISSUE_EXPLANATION = "Detected risky lending wording: {category}."

# FIXED VALUES — default glossary (term -> preferred), then the finance glossary file.
DEFAULT_GLOSSARY = [
    ("loan", "зээл"),
    ("interest rate", "хүүгийн хувь"),
    ("fee", "шимтгэл"),
    ("collateral", "барьцаа"),
    ("approval", "зөвшөөрөл"),
    ("application", "зээлийн хүсэлт"),
    ("final review", "эцсийн хяналт"),
]
GLOSSARY_FILES = {
    "lendex_finance": [
        ("loan", "зээл"),
        ("loan application", "зээлийн хүсэлт"),
        ("interest rate", "хүүгийн хувь"),
        ("fee", "шимтгэл"),
        ("collateral", "барьцаа"),
        ("term", "хугацаа"),
        ("income", "орлого"),
        ("employment", "ажил эрхлэлт"),
        ("final review", "эцсийн хяналт"),
        ("approval", "зөвшөөрөл"),
    ],
}
GLOSSARY_WARNING = "Use preferred Mongolian term '{preferred}' for '{source}'."

# FIXED VALUES — extraction dictionaries (first contained key wins).
EMPLOYMENT_TERMS = [
    ("ажилтай", "employed"),
    ("цалинтай", "salaried"),
    ("хувиараа", "self-employed"),
    ("self-employed", "self-employed"),
    ("employed", "employed"),
    ("salaried", "salaried"),
]
COLLATERAL_TERMS = [
    ("машин", "car"),
    ("автомашин", "car"),
    ("байр", "apartment"),
    ("орон сууц", "apartment"),
    ("үл хөдлөх", "property"),
    ("car", "car"),
    ("apartment", "apartment"),
    ("property", "property"),
]
LOAN_TYPE_TERMS = [
    ("хэрэглээний", "consumer"),
    ("бизнес", "business"),
    ("орон сууц", "mortgage"),
    ("business", "business"),
    ("consumer", "consumer"),
    ("mortgage", "mortgage"),
]
EXTRACTION_FIELDS = [
    "loan_amount", "loan_term_months", "monthly_income", "employment_status",
    "collateral", "loan_type", "phone_number",
]
# Context keys accepted for each required application field (chat route).
CONTEXT_ALIASES = {
    "loan_term_months": ["loan_term_months", "term"],
    "monthly_income": ["monthly_income", "income"],
    "employment_status": ["employment_status", "employment"],
}
FINANCE_GLOSSARY_ID = "lendex_finance"
MOCK_TEACHER_MODEL = "mock:Qwen3-235B-A22B-Instruct-2507"
REVIEW_REASON = "Human review recommended due to compliance sensitivity, glossary warnings, or low confidence."
# Heuristic confidence: base, short-text penalty, per-warning penalty, cap, clamp.
CONFIDENCE_BASE = 0.88
CONFIDENCE_SHORT_LEN = 20
CONFIDENCE_SHORT_PENALTY = 0.1
CONFIDENCE_WARNING_STEP = 0.05
CONFIDENCE_WARNING_CAP = 0.25
CONFIDENCE_MIN, CONFIDENCE_MAX = 0.2, 0.98
REVIEW_THRESHOLD = 0.75
# ---------------------------------------------------------------------------


def lexicon_rows():
    """Flattened lexicon in scan order: (ord, category, phrase, severity, alternative)."""
    rows = []
    for category, severity, alternative, phrases in COMPLIANCE_LEXICON:
        for phrase in phrases:
            rows.append((len(rows), category, phrase, severity, alternative))
    return rows


def merged_glossary(glossary_id: str | None = None):
    """Default terms overlaid by a glossary file: default order first, new keys after."""
    merged = dict(DEFAULT_GLOSSARY)
    if glossary_id and glossary_id in GLOSSARY_FILES:
        merged.update(dict(GLOSSARY_FILES[glossary_id]))
    return list(merged.items())
