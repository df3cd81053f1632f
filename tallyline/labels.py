"""Display strings and business constants.

FIXED VALUES. Every string below must equal the original billing job's text
for the outputs (report columns, reasons, notes, messages) to match it. They
are kept here together, in the order the job uses them, and nowhere else.
Client-specific constants (tax numbers, partner names, staff handles, record
ids) are NOT here: they are rows of the rule tables in ``rules.py``.
"""

# --- FIXED VALUES: canonical payment terms ---------------------------------
DEPOSIT = "депозит"
SEMI_MONTHLY = "постоплата. 15 и 30"
MONTHLY = "постоплата. ежемесячно"
WEEKLY = "постоплата. еженедельно"

# --- FIXED VALUES: sheet spellings accepted for each canonical term --------
TERMS_ALIASES = (
    ("депозит", DEPOSIT),
    ("депозит   ", DEPOSIT),
    ("депозит / была постоплата", DEPOSIT),
    ("постоплата каждый пн за предыдущую неделю", WEEKLY),
    ("оплата с агентских", WEEKLY),
    ("счет 15 и 30 числа\nкаждого месяца", SEMI_MONTHLY),
    ("постоплата за месяц", MONTHLY),
)

# --- FIXED VALUES: sheet cleaning ------------------------------------------
MISSING_MARK = "?"
SHEET_POSTPAY = "постоплата"
SHEET_STOPPED = "на стопе"
NOTE_BAD_INN = "Поле ИНН заполнено некорректно"
NOTE_SET_WEEKLY = "Не заполнен Депозит (тип отплаты). Установил 'постоплата. еженедельно'. "
NOTE_SET_DEPOSIT = "Не заполнен Депозит (тип отплаты). Установил 'депозит'. "
NOTE_AVG_DASH = "В поле 'Средний размер депозитов' есть '-'."
NOTE_MIN_DEFAULT = "Поле 'Порог остатка' не является числом (поставил 5000). "
NOTE_AVG_DEFAULT = "Поле 'Средний размер депозитов' не является числом (поставил 20000). "
DEFAULT_DEPOSIT_MIN = 5000
DEFAULT_DEPOSIT_AVG = 20000

# --- FIXED VALUES: synthesised terms for clients missing from the sheet ----
NO_INFO_PROJECT = "нет инфо"
NOTE_FILL_SHEET = "Заполнить Google таблицу"
STOP_FLAG = "на стопе"  # compared after lower(trim())

# --- FIXED VALUES: leads ----------------------------------------------------
DUPLICATE_FLAG = "Дубликат"

# --- FIXED VALUES: invoices -------------------------------------------------
STATUS_UNPOSTED = "Не опубликован"
STATUS_DELETED = "Удален"
STATUS_VALID = "Корректный"
PAY_UNPAID = "Не оплачен"
PAY_PART = "Оплачен частично"
PAY_FULL = "Оплачен"
PAY_OVER = "Оплата больше счета"
PAY_ERROR = "!!!ERROR!!!"
CATEGORY_DEFAULT = "Прочее"
CATEGORY_BILLABLE = "Лиды"

# --- FIXED VALUES: line-text classifier, first match wins ------------------
# (kind, patterns, label); kind "contains" matches any pattern as substring,
# kind "equals" matches the whole text.
LINE_CATEGORIES = (
    ("contains", ("SMM",), "SMM"),
    ("equals", ("Автообзвон",), "Автообзвон"),
    ("contains", ("Агентские услуги", "Агентское вознаграждение"), "Агентские услуги"),
    ("contains", ("абинета ВК",), "ВК"),
    ("contains", ("нтеграц", "Подключение к агрегатору"), "Интеграця"),
    ("contains", ("Контекст",), "Контекстная реклама"),
    ("contains", ("Оплата стоимости лидов", "Флоктори", "RIS PROMO"), "Лиды"),
    ("contains", ("Лендинг", "лендинг"), "Лендинг"),
    ("contains", ("Маркетинговые услуги",), "Маркетинговые услуги"),
    ("contains", ("Посев",), "Посевы"),
    ("contains", ("Таргет", "Пополнение бюджета"), "Таргет"),
    ("contains", ("Ведение страницы", "сайт"), "Сайт"),
    ("contains", ("трафик",), "Трафик"),
    ("contains", ("Услуги предикторов",), "Услуги предикторов"),
    ("contains", ("Разработка чат-бота",), "Чат бот"),
    ("contains", ("Тест",), "Тест"),
)

# --- FIXED VALUES: report section labels ------------------------------------
TXT_PAYMENT_TYPE = "Способ оплаты"
TXT_INTERVAL_LEADS = "Данные за отчетный период"
INTERVAL_LEADS_PREFIX = "лиды за период c "
INTERVAL_INVOICES_PREFIX = "счета за период c "
PERIOD_TO = " по "
TXT_INTERVAL_INVOICE = "(счета - лиды) за период"
TXT_TOTAL_LEADS = "вся история: лиды"
TXT_TOTAL_INVOICES = "вся история: счета"
TXT_TOTAL_INVOICE = "вся история: счета - лиды"
TXT_CHECK = "проверка необходимости выставления счетов"
TXT_COMMENT = "техническая информация"

# --- FIXED VALUES: new-invoice decision -------------------------------------
YES = "Да"
NO = "Нет"
REASON_EXCLUDED = "Не выставляю счета по этому клиенту"
REASON_STOPPED = "На стопе"
REASON_NO_LEADS = "Нет лидов за предыдущий период"
REASON_ALREADY_INVOICED = "В текущем периоде счет уже выставлен"
REASON_ABOVE_MIN = "Остаток больше мин депозита"
REASON_ACCOUNTING_SETUP = "Заполнить данные в 1С"
REASON_NO_TERMS = "В google таблице нет инфо по ИНН"

LONG_EXCLUDED_INN = ", ИНН "
LONG_EXCLUDED_TAIL = " - не выставляю счета по этому клиенту"
LONG_STOPPED = "В google-таблице статус - На стопе"
LONG_NO_LEADS = "Нет лидов с "
LONG_ALREADY_FROM = "C "
LONG_ALREADY_AMOUNT = " уже выставлен счет на "
LONG_ABOVE_MIN_HEAD = "Остаток ("
LONG_ABOVE_MIN_MID = ") больше мин депозита ("
LONG_ABOVE_MIN_TAIL = ")"
LONG_SETUP_HEAD = "По ИНН "
LONG_NO_PARTNER_TAIL = " в 1С отсутствуют данные в Catalog_Контрагенты"
LONG_NO_CONTRACT_TAIL = " в 1С отсутствуют данные в Catalog_ДоговорыКонтрагентов"
LONG_NO_TERMS = "В google таблице нет инфо по ИНН "

ERR_NO_TERMS = "Нет инфо в google таблице"
ERR_SETUP_HEAD = "В 1С не заполнены: "
ERR_SETUP_PARTNER = "Catalog_Контрагенты "
ERR_SETUP_CONTRACT = "Catalog_ДоговорыКонтрагентов"
ERR_SETUP_BLANK = " "
ERR_INVOICED_HEAD = "Счет на "
ERR_INVOICED_MID = ", но текущий баланс "

# --- FIXED VALUES: run summary ---------------------------------------------
SUMMARY_NONE = "Новых счетов нет"
SUMMARY_ONE = "Выставлен 1 счет"
SUMMARY_FEW = "Выставлено {n} счета"  # 2..4
SUMMARY_MANY = "Выставлено {n} счетов"  # 5 and more

# --- FIXED VALUES: message rendering ---------------------------------------
CHANNEL_ALARM = "alarm"
CHANNEL_DUE_SOON = "payment_soon"
CHANNEL_NEW_INVOICE = "new_invoices"
CHANNEL_PROCESS = "process"

MSG_UNKNOWN_PROJECT = "Таинственный Незнакомец"
MSG_PM = "PM "
MSG_PM_COMMENT = "ПМ коммент: "
MSG_CITY = ", город = "
MSG_INN_OPEN = "(ИНН = "
MSG_COMMENT_OPEN = ", комментарий = '"
MSG_COMMENT_CLOSE = "')"
MSG_COMMENT_NONE = "нет"
MSG_CANNOT_INVOICE = "!!! НЕ МОГУ ВЫСТАВИТЬ СЧЕТ !!!"
MSG_PROBLEMS = "Проблемы:"
MSG_PROBLEM_NO_TERMS = "- По клиенту нет инфо в Google-таблице\n"
MSG_PROBLEM_NO_PARTNER = "- В 1С нет инфо по клиенту (Catalog_Контрагенты)\n"
MSG_PROBLEM_NO_CONTRACT = "- В 1С нет инфо по договору (Catalog_ДоговорыКонтрагентов)\n"
MSG_DETAILS = "Детализация:"
MSG_DETAILS_ITALIC = "<i>детализация расчетов:</i>"
MSG_LEAD_COST = "стоимость лидов = "
MSG_INVOICE_SUM = "сумма счетов = "
MSG_CORRECTION = "корректировка = "
MSG_TOTAL_BALANCE = "ИТОГО БАЛАНС = "
MSG_BALANCE = "БАЛАНС = "
MSG_DUE_SOON = "<b>ПРИБЛИЖАЕТСЯ ОПЛАТА</b>"
MSG_UNDER_BILLED = "<b>СУММА СЧЁТА МЕНЬШЕ СТОИМОСТИ ЛИДОВ</b>"
MSG_OVERDUE = "<b>ОПЛАТА ПРОСРОЧЕНА</b>"
MSG_TERMS = "тип оплаты = "
MSG_DEPOSIT_MIN = "минимальный депозит = "
MSG_DEPOSIT_AVG = "средний депозит = "
MSG_REASON = "Причина (если есть): "
MSG_RESPONSIBLE = "Ответственный = "
MSG_INVOICE = "Счет : "
MSG_RUB_VAT = " руб. (НДС = "
MSG_REMAINDER = "итого остаток = "
MSG_LEAD_COUNT = "количество лидов = "
MSG_LEAD_PRICE = "цена лида = "

# invoice document
LINE_TEXT_DEPOSIT = "Оплата стоимости лидов (депозит)"
LINE_TEXT_POSTPAY = "Оплата стоимости лидов"
VAT_RATE_CODE = "НДС5"

# --- FIXED VALUES: accounting document field names, in document order ------
# (field name, source): "col:<column>" a report/line column, "const:<key>" a
# value from RuleSet.document_constants, "lit:<text>" a literal, or a Python
# literal (True / False / 0).
DOCUMENT_FIELDS = (
    ("Date", "col:run_date"),
    ("Posted", True),
    ("СтруктурнаяЕдиница_Key", "const:structural_unit"),
    ("Ответственный_Key", "const:responsible"),
    ("Контрагент_Key", "col:partner_id"),
    ("ДоговорКонтрагента_Key", "col:contract_id"),
    ("СуммаДокумента", "col:new_invoice_amount"),
    ("Организация_Key", "col:organization_id"),
    ("ОрганизацияПолучатель_Key", "col:organization_id"),
    ("Руководитель_Key", "col:manager_key"),
    ("Комментарий", "col:comment"),
    ("ВалютаДокумента_Key", "const:currency"),
    ("ДополнительныеУсловия_Key", "const:terms"),
    ("СпособДоставки_Key", "const:delivery"),
    ("ДокументБезНДС", False),
    ("ВидОперации", "lit:ТоварыИУслуги"),
    ("ВариантПечатиQRКода", "lit:НеПечатать"),
)
DOCUMENT_LINES_FIELD = "Товары"
DOCUMENT_LINE_FIELDS = (
    ("LineNumber", "lit:1"),
    ("Номенклатура", "const:item"),
    ("Номенклатура_Type", "lit:StandardODATA.Catalog_Номенклатура"),
    ("Содержание", "col:line_text"),
    ("Количество", "col:line_quantity"),
    ("Цена", "col:line_price"),
    ("Сумма", "col:new_invoice_amount"),
    ("ПроцентСкидки", 0),
    ("СуммаСкидки", 0),
    ("СтавкаНДС", "lit:" + VAT_RATE_CODE),
    ("СуммаНДС", "col:vat_amount"),
)
