"""Words, codes and weights that results depend on. They are data, in their given order."""

# Fixed values.
PREFIXES = ("现浇", "预制", "钢筋混凝土", "混凝土", "砼")
SUFFIXES = ("构件", "组件", "单元")

# Replaced one after another in names.
NAME_REPLACEMENTS = (("钢筋混凝土", "混凝土"), ("砼", "混凝土"), ("雨蓬", "雨篷"), ("楼梯平面", "楼梯"))

# Dropped from names.
NAME_DROPPED = "（）()、，,：:· \n"

# Replaced one after another in units.
UNIT_REPLACEMENTS = (("㎡", "m2"), ("m²", "m2"), ("M2", "m2"), ("M²", "m2"), ("m³", "m3"), ("M3", "m3"), ("M³", "m3"), ("n?", "m3"), ("m?", "m3"))

# Replaced one after another in search texts.
SEARCH_REPLACEMENTS = (
    ("砼", "混凝土"),
    ("现浇板", "实心楼板"),
    ("空心楼盖板", "空心楼板"),
    ("飘窗", "凸飘窗"),
    ("雨蓬", "雨篷"),
    ("门联窗", "连窗门"),
    ("窗台梁", "过梁"),
    ("基础连梁", "基础联系梁"),
    ("基础梁", "基础联系梁"),
    ("承台梁", "基础联系梁"),
    ("板洞", "洞"),
    ("板缝", "后浇带"),
    ("预制墙", "墙板"),
    ("预制柱", "实心柱"),
    ("预制梁", "叠合梁"),
    ("间壁墙", "轻质隔墙"),
    ("保温层", "保温隔热"),
    ("内墙面", "墙面"),
    ("外墙面", "墙面"),
)

# Dropped from search texts.
SEARCH_DROPPED = "，,。、“”‘’：:；;（）()[]{}<>《》·•-_\\/|"

# The first that a name contains is its family.
FAMILIES = (
    ("模板", "模板"),
    ("墙", "墙"),
    ("梁", "梁"),
    ("柱", "柱"),
    ("板", "板"),
    ("楼梯", "楼梯"),
    ("基础", "基础"),
    ("沟", "沟"),
    ("井", "井"),
    ("池", "池"),
    ("土方", "土方"),
    ("石方", "土方"),
    ("冻土", "土方"),
    ("淤泥", "土方"),
    ("回填", "土方"),
    ("场地", "场地"),
    ("钢", "钢构件"),
)
OTHER_FAMILY = "其他"

# Fixed values.
NULL_WORDS = ("", "none", "null", "nil", "n/a", "na", "undefined", "无", "暂无", "空", "未匹配", "未找到", "not matched")

# Fixed values.
VERB_PREFIXES = ("挖", "浇", "砌", "铺", "做", "装", "拆", "运", "填", "刷", "喷", "抹", "涂", "贴")
MODIFIERS = ("单独", "基坑", "沟槽", "大开挖", "干挖", "湿挖", "人工", "机械", "现浇", "预制")

# The first in a text is its bucket.
FOCUS_TERMS = (
    "楼地面",
    "墙面",
    "柱面",
    "幕墙",
    "隔墙",
    "楼梯",
    "屋面",
    "地沟",
    "明沟",
    "检查井",
    "集水井",
    "栏杆",
    "栏板",
    "踢脚线",
    "踢脚",
    "保温",
    "隔热",
    "防水",
    "吊顶",
    "天棚",
    "基础",
    "垫层",
    "模板",
    "门窗",
    "门",
    "窗",
    "墙",
    "柱",
    "梁",
    "板",
    "井",
)

# Words for comparisons, replaced one after another.
COMPARISONS = (
    ("大于等于", ">="),
    ("小于等于", "<="),
    ("不小于", ">="),
    ("不少于", ">="),
    ("不大于", "<="),
    ("不高于", "<="),
    ("高于", ">"),
    ("低于", "<"),
    ("大于", ">"),
    ("小于", "<"),
    ("＞", ">"),
    ("＜", "<"),
    ("≥", ">="),
    ("≤", "<="),
)

# Weights of match and review statuses.
STATUS_RANK = {"matched": 4, "candidate_only": 3, "conflict": 2, "unmatched": 1}
STATUS_SCORE = {"matched": 400.0, "candidate_only": 200.0, "conflict": 100.0, "unmatched": 0.0}
DEVIATION = {"matched": 0.0, "candidate_only": 0.45, "conflict": 0.75, "unmatched": 1.0}
TYPE_WEIGHT = {
    "chapter_heading": 6.0,
    "exact": 5.5,
    "exact_match": 5.5,
    "exact_name_overlap": 5.5,
    "exact_keyword_match": 5.0,
    "direct_match": 5.0,
    "partial_match": 4.0,
    "broader_category_match": 3.0,
    "chapter_semantic": 2.5,
    "semantic_match": 2.0,
    "candidate_only": 1.0,
    "unmatched": 0.0,
    "none": 0.0,
}
REVIEW_WEIGHT = {"auto_accepted": 3.0, "auto": 2.5, "suggested": 2.0, "unreviewed": 1.0, "needs_review": 0.5, "needs_manual_review": 0.5, "pending": 0.0, "pending_review": 0.0}

# Words that mean a calculation, and the codes they point to, in order.
CALCULATION_WORDS = ("体积", "面积", "长度", "数量", "中心线长度", "投影面积", "斜面积", "展开面积", "接触面积")

# Fixed values.
GENERIC_ATTRIBUTE_CODES = ("GJLX", "GJMC", "REGMC", "LAYMC", "LAYFW", "NBZ", "BJSGCL", "GJZDYZF")
GENERIC_ATTRIBUTE_NAME_PARTS = ("构件编号", "区域名称", "楼层名称", "楼层范围", "备注", "是否计算工程量", "构件做法")

# Names by which an attribute code is known.
ATTRIBUTE_HINTS = {
    "TLX": ["混凝土种类", "混凝土类型", "砼种类", "砼类型"],
    "TBH": ["混凝土强度等级", "砼强度等级", "强度等级", "砼标号", "混凝土等级", "标号"],
    "NYZTBH": ["混凝土强度等级", "砼强度等级", "强度等级", "砼标号", "混凝土等级", "标号"],
    "YZTBH": ["混凝土强度等级", "砼强度等级", "强度等级", "砼标号", "混凝土等级", "标号"],
    "JDFS": ["浇筑方式", "浇捣方式"],
    "HD": ["墙厚", "厚度", "墙体厚度", "挡墙厚度"],
    "QH": ["墙厚", "厚度", "墙体厚度"],
    "BH": ["板厚", "厚度"],
    "GD": ["高度", "墙高", "柱高", "梁高"],
    "CD": ["长度", "墙长", "梁长", "中心线长度"],
    "JMK": ["截面宽度", "宽度"],
    "JMG": ["截面高度", "高度"],
    "GJLB": ["构件类型", "墙类型", "柱类型", "梁类型", "板类型", "基础类型", "部位", "形式", "类型"],
}

# Components of special item names.
SPECIAL_ITEMS = {
    "钢筋混凝土墙": ["砼墙", "暗柱", "连梁", "暗梁"],
    "混凝土墙": ["砼墙"],
    "直行墙": ["砼墙"],
    "直形墙": ["砼墙"],
    "基础联系梁": ["基础梁", "基础连梁", "承台梁"],
    "楼梯": ["参数楼梯", "楼梯平面", "直形梯段", "螺旋梯段", "休息平台"],
    "矩形柱": ["柱"],
    "钢筋混凝土柱": ["柱"],
    "混凝土柱": ["柱"],
    "挖单独石方": ["土石方"],
    "挖基坑石方": ["土石方"],
    "挖沟槽石方": ["土石方"],
    "挖冻土": ["土石方"],
    "挖淤泥流砂": ["土石方"],
    "余方弃置": ["土石方"],
    "单独土石方回填": ["土石方", "房心回填", "灰土回填"],
}

# Components of a chapter where nothing else matches.
CHAPTER_FALLBACK = {
    "附录A 土石方工程": ["土石方", "平整场地", "房心回填"],
    "附录B 地基处理与边坡支护工程": ["灰土回填"],
    "附录C 桩基工程": ["桩基础"],
    "附录D 砌筑工程": ["砖墙"],
}

# Bases of a match that are strong.
STRONG_BASES = ("exact", "normalized", "alias_bridge", "special_rule", "chapter_rule")

# The headers of a table, each with the words it goes by, and those a table must have.
TABLE_HEADERS = {
    "项目编码": ("项目编码", "编码"),
    "项目名称": ("项目名称", "名称"),
    "项目特征": ("项目特征", "特征"),
    "计量单位": ("计量单位", "单位"),
    "工程量计算规则": ("工程量计算规则", "工程量计算代码", "工程量计算规则及说明"),
    "工作内容": ("工作内容",),
}
REQUIRED_HEADERS = ("项目编码", "项目名称", "项目特征")

# Units of measurement as a line of their own, and words by which a line is one of features.
LINE_UNITS = ("m", "m2", "m3", "m²", "m³", "㎡", "m2/m3", "km", "kg", "t", "樘", "个", "项", "座", "套", "根", "孔", "处", "块", "延长米", "10m2", "100m2", "1000m2", "10m3", "100m3", "n?", "0?")
FEATURE_LINE_WORDS = ("类别", "材质", "厚度", "深度", "方式", "品种", "规格", "做法", "名称", "尺寸", "部位", "面层", "运距", "强度", "断面", "高度", "宽度", "长度", "半径", "坡度", "掺量", "密实度", "土类别", "岩石类别")
RULE_STARTS = ("按", "以", "并按")

# Features that stand at the end of a name.
TRAILING_FEATURES = ("开挖深度", "冻土厚度", "土类别", "岩石类别", "填方部位", "材料品种", "密实度")

# Units of what is counted.
COUNT_UNITS = ("个", "樘", "套", "座", "块", "根", "孔", "件", "处", "项")

# Words of a paragraph that rules something, and the mark that one begins with.
RULE_TRIGGERS = ("项目特征", "可描述", "列项", "应按", "按本标准", "按本附录", "并入", "适用于", "包括", "不增加相应工程量", "工程量按")
RULE_MARK = r"^[A-Za-z][.,]?\s*\d+(?:\s*[.,]\s*\d+)*"

# What a paragraph is cleaned of, in order, and what stands around a term.
PARAGRAPH_REPLACEMENTS = (("|", "\n"), ("“", '"'), ("”", '"'), ("‘", "'"), ("’", "'"), ("．", "."), ("•", " "))
TERM_EDGES = " ：:，,。；;（）()"

# Between the terms of a scope; terms that are none; terms of one character that are.
SCOPE_BREAKS = r"[、,，;；/\n]|以及|及|和|与|或"
SCOPE_STOP_WORDS = ("本附录", "本标准", "项目特征", "工程量计算规则", "工程量", "工作内容", "项目编码", "编码", "相关项目", "相关", "相应", "设计要求", "设计文件", "本附录中", "本标准中", "项目")
SHORT_TERMS = ("墙", "梁", "柱", "板", "桩", "门", "窗", "沟", "井", "池")

# What a term of a scope loses: a size, a word before it, a phrase after it, words anywhere.
SCOPE_SIZE = r"(?i)面积\s*[<>=W≤≥]?\s*[\d.]+\s*(?:m2|m3|m|㎡|m²)?\s*的"
SCOPE_LEADS = "^(?:各种|各类|少量分散的|一般|其他|同类|本附录中|本标准中|本附录|本标准)"
SCOPE_TAILS = "(?:应按.*|可描述为.*|适用于.*|工作内容.*|工程量.*|项目编码列项.*|相关项目编码列项.*)$"
SCOPE_DROPPED = ("中的", "项目特征", "工程量计算规则", "工程量", "编码列项", "列项")
SCOPE_END = "项目"

# What a target loses: the standard before it, and words anywhere.
TARGET_LEAD = "^(?:本附录|本标准)[^的中]*[的中]"
TARGET_DROPPED = ("相关项目编码列项", "相应项目编码列项", "项目编码列项", "项目列项", "相关项目", "相应项目", "相关", "相应")

# The forms that clauses of a rule have.
ROUTE_FORM = r"(.+?)(?:应)?按(.+?)(?:相关项目|相应项目|项目)(?:编码)?列项"
INCLUDE_FORM, INCLUDE_NOT = r"^(.+?)包括(.+)", "工作内容"
DESCRIBED, DESCRIBED_FORM, DESCRIBED_NOT = "可描述为", r'^(.+?)的\s*"[^"]+"\s*可描述为', "项目特征中的"
ADDED_FORM = r"^(.+?)应在项目特征中(?:增加|明确)(.+?)描述"
CALCULATED_FORM, MERGED_FORM = r"^(.+?)(?:工程量)?按.+?计算", r"^(.+?)并入.+?(?:体积|面积|长度)"
FEATURE_NAMES, FEATURE_EXAMPLES = 4, 8

# Words that point to codes of calculations, in order (the first also needs a word of the second list), and words that make a rule one of calculation.
RULE_CODES = (("TJ", ("体积", "并入")), ("JCD", ("中心线长度", "净长")), ("CD", ("长度",)), ("MJ", ("面积",)), ("SL", ("数量",)))
FORMWORK, FORMWORK_WORDS, FORMWORK_CODE = "模板", ("接触面积", "模板面积"), "MBMJ"
RULE_KEYWORDS = ("模板", "体积", "面积", "接触面积", "中心线长度", "长度", "数量", "并入")
CALCULATED_WORDS = ("不增加相应工程量", "并入")

# The codes that words of a row point to, best first, and the words that a calculation's name then has; then those of the units.
PREFERRED_CODES = (
    (("模板",), ("MBMJ", "DMMB", "CMMB", "ZMBMJ", "ZMB"), ("模板", "接触面积")),
    (("体积",), ("TJ", "ZTJ", "JLQTJ", "DZJLQTJ", "CGTJ"), ("体积",)),
    (("面积",), ("MJ", "TYMJ", "MBMJ", "TQMJ", "DMMJ", "CMMJ"), ("面积", "投影面积", "接触面积")),
    (("长度",), ("CD", "JCD", "YCD"), ("长度",)),
    (("数量",), ("SL",), ("数量",)),
)
UNIT_CODES = (("m3", ("TJ", "ZTJ"), ("体积",)), ("m2", ("MJ", "TYMJ", "MBMJ"), ("面积",)), ("m", ("CD", "JCD"), ("长度",)))
CHAPTER_WORDS = ("体积", "面积", "长度", "数量", "模板")

# Words in the name of an attribute that holds text, and of one that holds numbers.
TEXT_NAME_HINTS = ("类型", "类别", "做法", "备注", "状态", "方式", "节点", "名称", "楼层", "区域", "编号", "标号", "钢筋", "模板", "规则", "砼", "抗震")
NUMBER_NAME_HINTS = ("宽", "高", "厚", "长", "径", "半径", "直径", "面积", "体积", "周长", "数量", "长度", "高度", "厚度", "标高", "坡度", "角度", "距离", "重量", "质量", "容重")

# The kinds of a workbook's sheets, in order, with the words in a sheet's name that say so.
SHEET_NAMES = {
    "attributes": ("属性", "attributes", "attr", "property", "properties", "属性列表", "项目特征", "特征", "feature", "features"),
    "calculations": ("计算", "calculations", "calc", "计算项目", "计算公式", "工程量"),
    "core_params": ("核心", "core", "coreparams", "核心项目", "核心参数", "参数"),
}

# Columns of a sheet, each with the names that it goes by, the first that is filled counts.
SHEET_COLUMNS = {
    "name": ("名称",),
    "code": ("CODE",),
    "choices": ("下拉",),
    "kind": ("数据类型",),
    "values": ("可选值", "下拉", "values", "值"),
    "value": ("属性值", "默认值", "value", "数值", "值"),
    "unit": ("单位", "unit", "计量单位"),
    "expression": ("计算表达式", "表达式", "formula", "公式"),
}
SHEET_DEFAULTS, VALUE_BREAKS = "属性值", r"[\r\n、,，|;；]+"

# Words of titles before and behind the body, titles of a table of contents, and how a title of the body begins.
FRONT_TITLES = ("封面", "题名页", "版权页", "公告", "前言", "目次", "contents")
BACK_TITLES = ("本标准用词说明", "引用标准名录", "条文说明", "封底")
CATALOGUE_TITLES = ("目次", "contents")
BODY_TITLE = r"^(?:\d|附录\s*[A-Z]|[A-Z]\.\d)"

# What a title has before its words, and the shortest form of it that is looked for.
TITLE_NUMBER = r"^(?:[A-Za-z]\.\d+(?:\.\d+)*|\d+(?:\.\d+)*|附录\s*[A-Z])\s*"
TITLE_APPENDIX = r"^附录\s*[A-Z]\s*"
LEAST_ANCHOR = 2
