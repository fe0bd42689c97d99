"""Instruction-set v1 vocabularies and templates.

FIXED VALUES: slot vocabularies, domain names, source metadata and message
templates of the five-domain lending instruction set, in declared order.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES
DOMAINS = ["borrower_chat", "extraction", "compliance_rewrite", "finance_translation",
           "missing_field_clarification"]
LOAN_TYPES = ["хэрэглээний", "бизнесийн", "орон сууцны", "автомашины", "эргэлтийн хөрөнгийн"]
AMOUNTS = ["3 сая", "5 сая", "8 сая", "10 сая", "12 сая", "15 сая", "20 сая", "25 сая", "30 сая", "50 сая"]
TERMS = ["6 сар", "9 сар", "12 сар", "18 сар", "24 сар", "36 сар", "48 сар", "60 сар", "3 жил", "5 жил"]
INCOMES = ["1.5 сая", "2 сая", "2.5 сая", "3 сая", "4 сая", "5 сая", "6 сая", "8 сая", "тогтмол бус", "улирлын"]
EMPLOYMENT = ["цалинтай", "хувиараа хөдөлмөр эрхэлдэг", "жижиг бизнес эрхэлдэг", "гэрээт ажилтай", "түр ажилтай"]
COLLATERAL = ["барьцаагүй", "автомашин", "орон сууц", "тоног төхөөрөмж", "агуулахын бараа"]
MISSING_FIELDS = ["сарын орлого", "зээлийн хугацаа", "холбоо барих утас", "ажил эрхлэлт", "барьцааны мэдээлэл"]
ENGLISH_TERMS = [
    ("loan application", "зээлийн хүсэлт"),
    ("interest rate", "хүүгийн хувь"),
    ("service fee", "үйлчилгээний шимтгэл"),
    ("collateral", "барьцаа"),
    ("final review", "эцсийн хяналт"),
]
RISKY_SENTENCES = [
    "Таны зээл заавал батална.",
    "Манай зээл хүү шимтгэлгүй хамгийн ашигтай.",
    "Та урьдчилан зөвшөөрөгдсөн тул санаа зовох зүйлгүй.",
    "Таны хүсэлт эцсийн байдлаар зөвшөөрөгдсөн.",
    "Татгалзсан шалтгаан нь та муу зээлдэгч.",
]
SOURCE = "synthetic_lendex_datagate_v1"
LICENSE_STATUS = "synthetic"
ALLOWED_USAGE = "training_allowed"
ID_FORMAT = "lendex-sft-%04d"
SYSTEM = ("Та Lendex болон Datagate-д зориулсан монгол хэлний зээлийн туслах. "
          "Та эелдэг, ойлгомжтой хариулж, зээлийн зөвшөөрөл амлахгүй.")

BORROWER_CHAT_USER = "Би {amount} төгрөгийн {loan_type} зээл {term} хугацаатай авах боломжтой юу?"
BORROWER_CHAT_ASSISTANT = (
    "Та {amount} төгрөгийн {loan_type} зээлийн хүсэлтээ урьдчилан шалгуулж болно. "
    "Эцсийн шийдвэр нь орлого, ажил эрхлэлт, барьцаа болон байгууллагын хяналтын дараа гарна. "
    "Та сарын орлого, ажил эрхлэлт, барьцааны мэдээллээ нэмж өгнө үү."
)
EXTRACTION_USER = (
    "Дараах зээлийн хүсэлтийг JSON болгож бүтэцлэ: {amount} төгрөгийн {loan_type} зээл, "
    "хугацаа {term}, сарын орлого {income}, ажил эрхлэлт {employment}, барьцаа {collateral}."
)
EXTRACTION_ASSISTANT = (
    "Та дараах бүтэцлэгдсэн мэдээллийг ашиглаж болно: "
    "{{"
    "\"loan_amount\":\"{amount}\","
    "\"loan_term\":\"{term}\","
    "\"monthly_income\":\"{income}\","
    "\"employment_status\":\"{employment}\","
    "\"collateral\":\"{collateral}\","
    "\"loan_type\":\"{loan_type}\","
    "\"phone_number\":null,"
    "\"missing_fields\":[\"холбоо барих утас\"]"
    "}}. Эцсийн шийдвэр зөвхөн нэмэлт хяналтын дараа гарна."
)
COMPLIANCE_USER = "Энэ өгүүлбэрийг зээлийн compliance-safe хэлбэрт зас: {risky}"
COMPLIANCE_ASSISTANT = (
    "Та дараах аюулгүй хувилбарыг ашиглаж болно: "
    "Таны зээлийн хүсэлтийг урьдчилан шалгаж болох бөгөөд хүү, шимтгэл, нөхцөл нь бүтээгдэхүүн, "
    "шалгуур болон гэрээний нөхцлөөс хамаарна. Эцсийн шийдвэр нэмэлт хяналтын дараа гарна."
)
TRANSLATION_USER = "Translate to Mongolian for a lending workflow: Please review the {english} for a {amount} loan."
TRANSLATION_ASSISTANT = (
    "Та энэ өгүүлбэрийг ингэж орчуулж болно: {amount} төгрөгийн зээлийн {mongolian}-ийг хянана уу. "
    "Энэ орчуулга нь зээлийн зөвшөөрөл амлахгүй бөгөөд эцсийн хяналт шаардлагатайг хадгална."
)
MISSING_USER = "{loan_type} зээлийн хүсэлтэд {field} дутуу байна. Харилцагчаас эелдгээр асуух мессеж бич."
MISSING_ASSISTANT = (
    "Та {loan_type} зээлийн хүсэлтээ үргэлжлүүлэхийн тулд {field}-ийн мэдээллээ нэмж өгнө үү. "
    "Энэ мэдээлэл нь урьдчилсан шалгалтад ашиглагдах бөгөөд эцсийн шийдвэр нэмэлт хяналтын дараа гарна."
)
# Slot selection per domain: slot -> (vocabulary, multiplier, offset) meaning
# vocabulary[(i * multiplier + offset) % len(vocabulary)].
SLOTS = {
    "borrower_chat": {"amount": ("AMOUNTS", 1, 0), "term": ("TERMS", 2, 0), "loan_type": ("LOAN_TYPES", 3, 0)},
    "extraction": {"amount": ("AMOUNTS", 1, 1), "term": ("TERMS", 1, 3), "income": ("INCOMES", 1, 5),
                   "employment": ("EMPLOYMENT", 1, 2), "collateral": ("COLLATERAL", 1, 4),
                   "loan_type": ("LOAN_TYPES", 1, 1)},
    "compliance_rewrite": {"risky": ("RISKY_SENTENCES", 1, 0)},
    "finance_translation": {"english": ("ENGLISH_EN", 1, 0), "mongolian": ("ENGLISH_MN", 1, 0),
                            "amount": ("AMOUNTS", 1, 2)},
    "missing_field_clarification": {"field": ("MISSING_FIELDS", 1, 0), "loan_type": ("LOAN_TYPES", 1, 4)},
}
TEMPLATES = {
    "borrower_chat": (BORROWER_CHAT_USER, BORROWER_CHAT_ASSISTANT),
    "extraction": (EXTRACTION_USER, EXTRACTION_ASSISTANT),
    "compliance_rewrite": (COMPLIANCE_USER, COMPLIANCE_ASSISTANT),
    "finance_translation": (TRANSLATION_USER, TRANSLATION_ASSISTANT),
    "missing_field_clarification": (MISSING_USER, MISSING_ASSISTANT),
}
# ---------------------------------------------------------------------------

VOCABS = {
    "AMOUNTS": AMOUNTS, "TERMS": TERMS, "INCOMES": INCOMES, "EMPLOYMENT": EMPLOYMENT,
    "COLLATERAL": COLLATERAL, "LOAN_TYPES": LOAN_TYPES, "MISSING_FIELDS": MISSING_FIELDS,
    "RISKY_SENTENCES": RISKY_SENTENCES,
    "ENGLISH_EN": [e for e, _ in ENGLISH_TERMS], "ENGLISH_MN": [m for _, m in ENGLISH_TERMS],
}
