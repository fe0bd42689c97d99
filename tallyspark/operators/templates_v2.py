"""Credit-analyst instruction set v2: vocabularies and templates.

FIXED VALUES: tasks, sectors, collaterals, documents, system prompt and the ten
task templates (user prefix, assistant text), in declared order.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES
TASKS = [
    "credit_memo",
    "borrower_risk_classification",
    "financial_ratio_explanation",
    "loan_application_summary",
    "collateral_assessment",
    "repayment_capacity_analysis",
    "red_flag_detection",
    "lender_recommendation",
    "financial_statement_summary",
    "cash_flow_lending_decision",
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
COLLATERALS = [
    ("агуулахын үл хөдлөх хөрөнгө", 180),
    ("ачааны автомашин", 95),
    ("орон сууц", 220),
    ("үйлдвэрийн тоног төхөөрөмж", 130),
    ("борлуулах бараа материал", 70),
]
MISSING_DOCS = [
    "сүүлийн 12 сарын дансны хуулга",
    "татварын тайлан",
    "зээлийн зориулалтын дэлгэрэнгүй тайлбар",
    "барьцааны үнэлгээний тайлан",
    "үндсэн харилцагчдын гэрээ",
]
TERM_CHOICES = [6, 9, 12, 18, 24, 36]
SOURCE = "synthetic_lendex_credit_analyst_v2"
ID_FORMAT = "lendex-v2-%05d"
SYSTEM = ("Та Lendex болон Datagate-д зориулсан монгол хэлтэй зээлийн шинжээч. "
          "Дотоод бодлоо бүү харуул. Богино, бүтэцтэй, тооцоотой, мэргэжлийн хариул.")
BASE_INPUT = (
    "Салбар: {sector}; орлого {revenue} сая; зардал {expense} сая; "
    "өр төлбөр {debt} сая; мөнгөн үлдэгдэл {cash} сая; "
    "хүссэн зээл {loan_amount} сая; хугацаа {term_months} сар; "
    "барьцаа: {collateral} ({collateral_value} сая үнэлгээтэй)."
)
USER_PREFIX = {
    "credit_memo": "Доорх мэдээлэл дээр үндэслэн богино credit memo бич: ",
    "borrower_risk_classification": "Зээлдэгчийн эрсдэлийг ангилж тайлбарла: ",
    "financial_ratio_explanation": "Зээлдүүлэгчид хэрэгтэй санхүүгийн харьцааг тайлбарла: ",
    "loan_application_summary": "Зээлийн хүсэлтийг товч хураангуйл: ",
    "collateral_assessment": "Барьцааны хангалттай эсэхийг үнэл: ",
    "repayment_capacity_analysis": "Төлбөрийн чадварыг тооцоотой үнэл: ",
    "red_flag_detection": "Зээлийн хүсэлтээс улаан дохио илрүүл: ",
    "lender_recommendation": "Зээлдүүлэгчийн практик шийдвэрийн санал бич: ",
    "financial_statement_summary": "Санхүүгийн тайланг зээлдүүлэгчид зориулж хураангуйл: ",
    "cash_flow_lending_decision": "Мөнгөн урсгалд суурилсан зээлийн шийдвэр гарга: ",
}
ASSISTANT = {
    "credit_memo": (
        "Зээлийн товч memo\n"
        "- Эрсдэлийн түвшин: {level}\n"
        "- Ашиг: {profit_m}; ашгийн маржин: {margin_p}; "
        "өр/орлого: {debt_p}; мөнгө/өр: {cash_p}.\n"
        "- Сарын ойролцоо төлөлт: {repay_m}; барьцааны бүрхэлт: {coverage2}x.\n"
        "- Шийдвэрийн үндэслэл: {sector} бизнесийн орлого, зардлын бүтэц болон одоогийн өрийн ачааллыг хамтад нь харгалзав.\n"
        "- Дутуу баримт: {missing_doc}.\n"
        "- {recommendation} Эцсийн шийдвэр нэмэлт хяналтын дараа гарна."
    ),
    "borrower_risk_classification": (
        "Эрсдэлийн ангилал: {level}\n"
        "- Ашгийн маржин {margin_p}, зардлын харьцаа {expense_p}, "
        "өр/орлого {debt_p} байна.\n"
        "- Мөнгөн үлдэгдэл/өрийн харьцаа {cash_p} тул богино хугацааны дарамтыг тусгайлан шалгана.\n"
        "- Дутуу баримт: {missing_doc}.\n"
        "- Та шийдвэр гаргахаас өмнө дансны бодит эргэлт болон барьцааны үнэлгээг тулган баталгаажуулна уу."
    ),
    "financial_ratio_explanation": (
        "Гол санхүүгийн харьцаанууд\n"
        "- Ашиг = орлого - зардал = {profit_m}.\n"
        "- Ашгийн маржин = ашиг / орлого = {margin_p}; үйл ажиллагааны ашигт ажиллагааг харуулна.\n"
        "- Өр/орлого = {debt_p}; орлоготой харьцуулсан өрийн дарамт.\n"
        "- Мөнгө/өр = {cash_p}; ойрын төлбөр даах нөөц.\n"
        "- Зардлын харьцаа = {expense_p}; зардлын сахилга батыг үнэлнэ. "
        "Та эдгээрийг дансны хуулга, татварын тайлантай тулгаж шалгана уу."
    ),
    "loan_application_summary": (
        "Зээлийн хүсэлтийн хураангуй\n"
        "- Хүсэлт: {loan_m}, {term_months} сарын хугацаа.\n"
        "- Бизнес: {sector}; орлого {revenue_m}, зардал {expense_m}, ашиг {profit_m}.\n"
        "- Барьцаа: {collateral}, үнэлгээ {collateral_value_m}, бүрхэлт {coverage2}x.\n"
        "- Эрсдэл: {level}; дутуу баримт: {missing_doc}.\n"
        "Та хүсэлтийг эцсийн зөвшөөрөл гэж үзэлгүй, нэмэлт баталгаажуулалтын дараа шийдвэрлэнэ үү."
    ),
    "collateral_assessment": (
        "Барьцааны үнэлгээ\n"
        "- Барьцаа: {collateral}; үнэлгээ {collateral_value_m}.\n"
        "- Зээлийн дүн: {loan_m}; барьцааны бүрхэлт {coverage2}x.\n"
        "- Барьцааны эрсдэл: {collateral_level}; хөрвөх чадвар, өмчлөл, даатгал, үнэлгээний огноог шалгана.\n"
        "- Дутуу баримт: {missing_doc}.\n"
        "Та барьцаа хангалттай байсан ч орлогын мөнгөн урсгалыг тусад нь баталгаажуулах шаардлагатай."
    ),
    "repayment_capacity_analysis": (
        "Төлбөрийн чадварын шинжилгээ\n"
        "- Сарын ойролцоо төлөлт: {repay_m}.\n"
        "- Ашиг {profit_m}; ашиг/сарын төлөлт {repay_cov2}x.\n"
        "- Өр/орлого {debt_p}, мөнгө/өр {cash_p}.\n"
        "- Эрсдэлийн түвшин: {repay_level}; улирлын хэлбэлзэл болон дансны бодит орлогыг шалгана.\n"
        "- Дутуу баримт: {missing_doc}. Эцсийн шийдвэр нэмэлт хяналтын дараа гарна."
    ),
    "red_flag_detection": (
        "Улаан дохионы шалгалт\n"
        "- Илэрсэн эрсдэл: {flags}.\n"
        "- Тооцоо: өр/орлого {debt_p}, мөнгө/өр {cash_p}, "
        "зардлын харьцаа {expense_p}.\n"
        "- Дутуу баримт: {missing_doc}.\n"
        "Та эдгээрийг тайлбарлах нэмэлт баримт авсны дараа шийдвэрийн санал боловсруулна уу."
    ),
    "lender_recommendation": (
        "Зээлдүүлэгчийн санал\n"
        "- Эрсдэл: {level}; ашиг {profit_m}, ашгийн маржин {margin_p}, "
        "өр/орлого {debt_p}.\n"
        "- Нөхцөл: {loan_m}-оос хэтрүүлэхгүй, {term_months} сарын дотор, "
        "орлого баталгаажсаны дараа олгох боломжийг судална.\n"
        "- Шаардлагатай баримт: {missing_doc}.\n"
        "- {recommendation}"
    ),
    "financial_statement_summary": (
        "Санхүүгийн тайлангийн хураангуй\n"
        "- Орлого {revenue_m}, зардал {expense_m}, ашиг {profit_m}.\n"
        "- Ашгийн маржин {margin_p}, зардлын харьцаа {expense_p}.\n"
        "- Өр төлбөр {debt_m}, мөнгөн үлдэгдэл {cash_m}, мөнгө/өр {cash_p}.\n"
        "- Эрсдэлийн түвшин: {level}; {sector} бизнесийн ашигт ажиллагаа болон өрийн дарамтыг хамтад нь үнэлэх шаардлагатай.\n"
        "- Дутуу баримт: {missing_doc}."
    ),
    "cash_flow_lending_decision": (
        "Мөнгөн урсгалд суурилсан шийдвэр\n"
        "- Ашиг {profit_m}; сарын төлөлт {repay_m}; "
        "төлөлтийн дараах үлдэх дүн {net_m}.\n"
        "- Өр/орлого {debt_p}; мөнгө/өр {cash_p}.\n"
        "- Эрсдэлийн түвшин: {cashflow_level}; мөнгөн урсгал тасалдах эсэхийг дансны хуулгаар шалгана.\n"
        "- Дутуу баримт: {missing_doc}.\n"
        "Та эцсийн шийдвэрийг зөвхөн баталгаажуулсан мөнгөн урсгал, барьцаа, бодлогын шалгуурт үндэслэн гаргана уу."
    ),
}
# ---------------------------------------------------------------------------
