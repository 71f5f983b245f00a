"""The case-table data model: levels, their fields, closed domains and weights."""

from __future__ import annotations

from pyspark.sql import types as T

LEVEL = "步骤层级"

# Level names in their order, each level's fields, closed domains, and the fields' weights in scores.
LEVEL_ORDER = ("用例", "子用例", "步骤", "判据", "执行步骤")
LEVEL_FIELDS = {
    "用例": ("步骤层级", "说明", "注意事项"),
    "子用例": ("步骤层级", "说明", "注意事项"),
    "步骤": ("步骤层级", "说明", "注意事项", "操作内容", "操作对象", "操作目的", "是否同时发送", "多判据组合条件"),
    "判据": ("步骤层级", "是否使用设备", "操作类型", "判据类型", "判据范围", "判据描述", "左值", "右值", "单位"),
    "执行步骤": ("步骤层级", "设备类型", "设备单元号", "设备指令号", "设备参数", "判据关联标志"),
}
CLOSED_DOMAINS = {
    "是否同时发送": ("是", "否"),
    "多判据组合条件": ("全部成功", "任一成功"),
    "是否使用设备": ("是", "否"),
    "操作类型": ("仅操作", "选值", "录值"),
    "判据类型": ("其他", "判据关联"),
}
WEIGHTS = {
    "说明": 1.5, "操作内容": 1.3, "操作对象": 1.3, "注意事项": 1.2, "判据描述": 1.2, "操作目的": 1.1, "步骤层级": 1.0, "是否同时发送": 1.0,
    "多判据组合条件": 1.0, "是否使用设备": 1.0, "操作类型": 1.0, "判据类型": 1.0, "判据范围": 1.0, "左值": 1.0, "右值": 1.0, "判据关联标志": 1.0, "单位": 0.8,
}
DEVICE_FIELDS = ("设备类型", "设备单元号", "设备指令号", "设备参数")
REFERENCE_FIELDS = ("左值", "右值", "判据关联标志")
NUMERIC_FIELDS = ("左值", "右值", "判据范围")
BOOLEAN_FIELDS = ("是否同时发送", "是否使用设备")
COMBINE_FIELD = "多判据组合条件"
ROW_LIST_KEYS = ("步骤列表", "rows", "steps")
JUDGE_LIST_KEYS = ("步骤列表", "rows", "steps", "table")
RECORD_LIST_KEYS = ("rows", "pred_rows", "步骤列表")
#: An identifier behind @, the operators that get spaces, and texts that say nothing.
REFERENCE_PATTERN = r"@[A-Za-z0-9_\u4e00-\u9fff]+"
OPERATOR_PATTERN = r"[*+\-/]"
NOTHING = ("", "null", "None", "[]")
COMBINE_WORDS = {"全部成功": "all", "任一成功": "any"}
# End of fixed values.

EXECUTION = LEVEL_ORDER[-1]

#: What kind of value a field holds. References come before numbers: a field that is in both is a reference.
FIELD_KINDS = dict.fromkeys(NUMERIC_FIELDS, "number") | dict.fromkeys(BOOLEAN_FIELDS, "flag") | dict.fromkeys(REFERENCE_FIELDS, "reference") | {COMBINE_FIELD: "combination"}

ROW = T.MapType(T.StringType(), T.StringType())
CASES = T.StructType([T.StructField("id", T.StringType()), T.StructField("source", T.StringType()), T.StructField("content", T.StringType()), T.StructField("rows", T.ArrayType(ROW))])
MESSAGES = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]))
CHATS = T.StructType([T.StructField("id", T.StringType()), T.StructField("source", T.StringType()), T.StructField("messages", MESSAGES)])
