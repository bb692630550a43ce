"""Schemas and fixed values shared by the readers, plans and counters."""

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

# Names and types of the two files.
SHOP_INFO_SCHEMA = StructType(
    [
        StructField("shop_id", StringType()),
        StructField("city_name", StringType()),
        StructField("location_id", StringType()),
        StructField("per_pay", IntegerType()),
        StructField("score", IntegerType()),
        StructField("comment_cnt", IntegerType()),
        StructField("shop_level", IntegerType()),
        StructField("cate_1_name", StringType()),
        StructField("cate_2_name", StringType()),
        StructField("cate_3_name", StringType()),
    ]
)

# The time stamp stays text: a day is its first ten characters, whatever they are.
USER_PAY_SCHEMA = StructType(
    [
        StructField("user_id", StringType()),
        StructField("shop_id", StringType()),
        StructField("time_stamp", StringType()),
    ]
)

RECORD_SCHEMA = StructType([StructField("key", StringType()), StructField("value", StringType())])

COUNTER_SCHEMA = StructType(
    [
        StructField("k", StringType()),
        StructField("count", LongType()),
        StructField("batch_id", LongType()),
        StructField("run", LongType()),
    ]
)

# Counter key prefixes.
SHOP_KEY_PREFIX = "jiaoyi"
CITY_KEY_PREFIX = "交易"

# Cities and category of the popularity ranking (Beijing, Shanghai, Guangzhou; hot pot).
WELCOME_CITIES = ("北京", "上海", "广州")
WELCOME_CATEGORY = "火锅"

# Romanised province names and the names shown to readers.
PROVINCE_NAMES = {
    "BeiJing": "北京",
    "ShangHai": "上海",
    "TianJin": "天津",
    "ChongQing": "重庆",
    "XiangGang": "香港",
    "Aomen": "澳门",
    "AnHui": "安徽",
    "FuJian": "福建",
    "GuangDong": "广东",
    "GuangXi": "广西",
    "GuiZhou": "贵州",
    "GanSu": "甘肃",
    "HaiNan": "海南",
    "HeBei": "河北",
    "HeNan": "河南",
    "HeiLongJiang": "黑龙江",
    "HuBei": "湖北",
    "HuNan": "湖南",
    "JiLin": "吉林",
    "JiangSu": "江苏",
    "JiangXi": "江西",
    "LiaoNing": "辽宁",
    "NeiMengGu": "内蒙古",
    "NingXia": "宁夏",
    "QingHai": "青海",
    "ShanXi1": "山西",
    "ShanXi3": "陕西",
    "ShanDong": "山东",
    "SiChuan": "四川",
    "TaiWan": "台湾",
    "XiZang": "西藏",
    "XinJiang": "新疆",
    "YunNan": "云南",
    "ZheJiang": "浙江",
}
