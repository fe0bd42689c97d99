"""Strict credit-analyst instruction set v3: quotas, vocabularies, templates.

FIXED VALUES: domain quotas (in order), sectors, document sets, task names,
focus sentences and answer templates.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES
DOMAIN_QUOTAS = [
    ("credit_memo_numeric", 500),
    ("repayment_capacity_numeric", 300),
    ("lender_recommendation_numeric", 250),
    ("financial_ratios_numeric", 200),
    ("risk_classification_structured", 150),
    ("missing_documents_request", 100),
]
SECTORS = [
    "хүнсний бөөний худалдаа",
    "барилгын материалын худалдаа",
    "эмийн сан",
    "тээвэр ложистик",
    "оёдлын үйлдвэрлэл",
    "жижиг ресторан",
    "сэлбэгийн худалдаа",
    "сүү, сүүн бүтээгдэхүүний түгээлт",
    "цахилгаан барааны дэлгүүр",
    "хөдөө аж ахуйн тоног төхөөрөмжийн худалдаа",
]
DOC_SETS = [
    ["Дансны хуулга", "Татварын тайлан", "Зээлийн түүх", "Барьцааны үнэлгээ"],
    ["Дансны хуулга", "Татварын тайлан", "Үндсэн гэрээ", "Барьцааны үнэлгээ"],
    ["Дансны хуулга", "Зээлийн түүх", "Борлуулалтын гэрээ", "Барьцааны үнэлгээ"],
    ["Татварын тайлан", "Дансны хуулга", "Бараа материалын жагсаалт", "Зээлийн түүх"],
]
EXPENSE_RATES = [0.48, 0.55, 0.62, 0.70, 0.82]
TERM_CHOICES = [6, 9, 12, 18, 24, 30, 36]
SOURCE = "synthetic_lendex_credit_analyst_v3"
ID_PREFIX = "lendex-v3-"  # id = prefix + domain + "-" + 5-digit global index
SYSTEM = ("Та Lendex болон Datagate-д зориулсан монгол хэлтэй зээлийн шинжээч. "
          "Зөвхөн эцсийн хариу бич. Тооцоог өгөгдсөн тооноос гарга. Дотоод бодол бүү харуул.")
TASK_NAMES = {
    "credit_memo_numeric": "Богино credit memo бич",
    "repayment_capacity_numeric": "Төлбөрийн чадварыг тооцоотой үнэл",
    "lender_recommendation_numeric": "Зээлдүүлэгчийн шийдвэрийн санал бич",
    "financial_ratios_numeric": "Санхүүгийн гол харьцааг тайлбарла",
    "risk_classification_structured": "Зээлдэгчийн эрсдэлийг бүтэцтэй ангил",
    "missing_documents_request": "Дутуу баримтыг эелдгээр хүс",
}
FOCUS = {
    "credit_memo_numeric": "Зээлийн memo-д өгөгдсөн бүх тоог ашиглан тооцоо хийв.",
    "repayment_capacity_numeric": "Төлбөрийн чадварыг ашиг, сарын төлбөр, өрийн дарамтаар үнэлэв.",
    "lender_recommendation_numeric": "Зээлдүүлэгчийн санал нь тооцоолсон ашиг ба хөрвөх чадварт үндэслэв.",
}
PROMPT = (
    "{task}: Салбар {sector}. Орлого {revenue} сая, "
    "зардал {expense} сая, өр төлбөр {debt} сая, "
    "мөнгөн үлдэгдэл {cash} сая, хүссэн зээл {loan_amount} сая, "
    "хугацаа {term_months} сар."
)
REPAYMENT_LINE = "\n- Сарын төлбөрийн ойролцоо тооцоо: {repay_m}"
STRICT_NUMERIC = (
    "Зээлийн товч үнэлгээ\n\n"
    "Эрсдэлийн түвшин: {level}\n\n"
    "Санхүүгийн тооцоолол:\n"
    "- Орлого: {revenue_m}\n"
    "- Зардал: {expense_m}\n"
    "- Тооцоолсон ашиг: {profit_m}\n"
    "- Ашгийн маржин: {margin_p}\n"
    "- Зардлын харьцаа: {expense_p}\n"
    "- Өр/орлогын харьцаа: {debt_p}\n"
    "- Мөнгө/өрийн харьцаа: {cash_p}"
    "{repayment_line}\n\n"
    "Үнэлгээ:\n"
    "{focus} Орлого, зардлын бүтэц, өрийн дарамт, хөрвөх чадвар зэрэг үзүүлэлтээр санхүүгийн бүтэц дүгнэгдэв. "
    "Мөнгөн үлдэгдэл нь богино хугацааны төлбөрийн чадварт шууд нөлөөлөх тул дансны бодит эргэлтээр баталгаажуулах шаардлагатай.\n\n"
    "Зөвлөмж:\n"
    "{advice}. Эцсийн шийдвэрийг баталгаажсан баримт, бодлогын шалгуур, зээлийн хорооны хяналтын дараа гаргана.\n\n"
    "Дутуу баримт:\n"
    "{docs_block}"
)
RATIO_ANSWER = (
    "Санхүүгийн харьцааны тайлбар\n\n"
    "- Тооцоолсон ашиг: {profit_m} буюу орлогоос зардлыг хассан дүн.\n"
    "- Ашгийн маржин: {margin_p}; үйл ажиллагааны ашигт ажиллагааг харуулна.\n"
    "- Зардлын харьцаа: {expense_p}; зардлын сахилга бат болон ашигт дарамтыг үнэлнэ.\n"
    "- Өр/орлогын харьцаа: {debt_p}; өрийн дарамт орлоготой харьцуулахад ямар түвшинд байгааг харуулна.\n"
    "- Мөнгө/өрийн харьцаа: {cash_p}; хөрвөх чадвар богино хугацааны өрийг даах эсэхийг харуулна.\n\n"
    "Эрсдэлийн түвшин: "
    "{level}. Та эдгээр тооцоог дансны хуулга, татварын тайлан, зээлийн түүхтэй тулган баталгаажуулна уу."
)
RISK_ANSWER = (
    "Эрсдэлийн түвшин: {level}\n\n"
    "Үндэслэл:\n"
    "- Ашгийн маржин {margin_p}, өр/орлогын харьцаа {debt_p}, "
    "мөнгө/өрийн харьцаа {cash_p} байна.\n"
    "- Санхүүгийн бүтэц, өрийн дарамт, хөрвөх чадварын үзүүлэлтүүдийг хамтад нь авч үзэхэд шийдвэрийг шууд батлах бус нэмэлт баталгаажуулалт шаардлагатай.\n\n"
    "Практик алхам:\n"
    "{advice}. Дутуу баримтад {docs_inline} орно."
)
MISSING_DOCS_ANSWER = (
    "Дутуу баримтын хүсэлт\n\n"
    "Та зээлийн хүсэлтийг бүрэн үнэлүүлэхийн тулд дараах баримтыг ирүүлнэ үү:\n"
    "{docs_block}\n\n"
    "Эдгээр баримт нь орлого, өрийн дарамт, хөрвөх чадвар, барьцааны үнэлгээг баталгаажуулахад ашиглагдана. "
    "Баримт бүрдсэний дараа эрсдэлийн түвшин болон зөвлөмжийг дахин шинэчилнэ."
)
ANSWER_TEMPLATE = {
    "credit_memo_numeric": STRICT_NUMERIC,
    "repayment_capacity_numeric": STRICT_NUMERIC,
    "lender_recommendation_numeric": STRICT_NUMERIC,
    "financial_ratios_numeric": RATIO_ANSWER,
    "risk_classification_structured": RISK_ANSWER,
    "missing_documents_request": MISSING_DOCS_ANSWER,
}
# v3 quality-gate lists.
BAD_PHRASES = [
    "Хуцлах хугацаа",
    "Өрийн дарамтын маргааш",
    "ашгийн хураамж",
    "дарамтын харьцаа",
    "дотоодын орлого",
    "төлбөр дуусгах чадвар",
    "зээл өгөнцөөр",
    "зардалын",
]
REQUIRED_NUMERIC_FIELDS = [
    "Тооцоолсон ашиг",
    "Ашгийн маржин",
    "Зардлын харьцаа",
    "Өр/орлогын харьцаа",
    "Мөнгө/өрийн харьцаа",
    "Эрсдэлийн түвшин",
    "Зөвлөмж",
]
STRICT_MEMO_DOMAINS = ["credit_memo_numeric", "lender_recommendation_numeric"]
NUMERIC_DOMAINS = [
    "credit_memo_numeric",
    "repayment_capacity_numeric",
    "lender_recommendation_numeric",
    "financial_ratios_numeric",
    "risk_classification_structured",
]
# Prompt figures: key -> (label, unit) read back as "<label> <n> <unit>".
PROMPT_FIGURES = [
    ("revenue", "Орлого", "сая"),
    ("expense", "зардал", "сая"),
    ("debt", "өр төлбөр", "сая"),
    ("cash", "мөнгөн үлдэгдэл", "сая"),
    ("loan_amount", "хүссэн зээл", "сая"),
    ("term_months", "хугацаа", "сар"),
]
METRIC_LABELS = [
    "Орлого", "Зардал", "Тооцоолсон ашиг", "Ашгийн маржин", "Зардлын харьцаа",
    "Өр/орлогын харьцаа", "Мөнгө/өрийн харьцаа", "Сарын төлбөрийн ойролцоо тооцоо",
]
STRICT_METRIC_LABELS = ["Тооцоолсон ашиг", "Ашгийн маржин", "Зардлын харьцаа", "Өр/орлогын харьцаа",
                        "Мөнгө/өрийн харьцаа"]
# ---------------------------------------------------------------------------

CYCLE = sum(q for _, q in DOMAIN_QUOTAS)
