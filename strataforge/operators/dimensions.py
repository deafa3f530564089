"""Small places tables that lookups depend on, and loaders for tables that users keep in files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Middles of countries and larger regions: latitude, longitude.
CENTROIDS = {
    "China": (35.86, 104.19),
    "USA": (37.09, -95.71),
    "United States": (37.09, -95.71),
    "Canada": (56.13, -106.35),
    "Australia": (-25.27, 133.78),
    "Russia": (61.52, 105.32),
    "Brazil": (-14.24, -51.93),
    "India": (20.59, 78.96),
    "Argentina": (-38.42, -63.62),
    "Chile": (-35.68, -71.54),
    "Peru": (-9.19, -75.02),
    "Mexico": (23.63, -102.55),
    "South Africa": (-30.56, 22.94),
    "Iran": (32.43, 53.69),
    "Kazakhstan": (48.02, 66.92),
    "Mongolia": (46.86, 103.85),
    "Turkey": (38.96, 35.24),
    "Spain": (40.46, -3.75),
    "Portugal": (39.4, -8.22),
    "Germany": (51.17, 10.45),
    "France": (46.23, 2.21),
    "Finland": (61.92, 25.75),
    "Sweden": (60.13, 18.64),
    "Norway": (60.47, 8.47),
    "UK": (55.38, -3.44),
    "United Kingdom": (55.38, -3.44),
    "Japan": (36.2, 138.25),
    "South Korea": (35.91, 127.77),
    "North Korea": (40.34, 127.51),
    "Philippines": (12.88, 121.77),
    "Indonesia": (-0.79, 113.92),
    "Malaysia": (4.21, 101.98),
    "Thailand": (15.87, 100.99),
    "Vietnam": (14.06, 108.28),
    "Myanmar": (21.91, 95.96),
    "Pakistan": (30.38, 69.35),
    "Afghanistan": (33.94, 67.71),
    "Uzbekistan": (41.38, 64.59),
    "Kyrgyzstan": (41.2, 74.77),
    "Tajikistan": (38.86, 71.28),
    "Ghana": (7.95, -1.02),
    "Nigeria": (9.08, 8.67),
    "Tanzania": (-6.37, 34.89),
    "Kenya": (-0.02, 37.91),
    "Ethiopia": (9.15, 40.49),
    "Democratic Republic of Congo": (-4.04, 21.76),
    "DRC": (-4.04, 21.76),
    "Zambia": (-13.13, 27.85),
    "Zimbabwe": (-19.02, 29.15),
    "Botswana": (-22.33, 24.68),
    "Morocco": (31.79, -7.09),
    "Algeria": (28.03, 1.66),
    "Egypt": (26.82, 30.8),
    "Tunisia": (33.89, 9.54),
    "Sudan": (12.86, 30.22),
    "Cameroon": (3.85, 11.5),
    "Rwanda": (-1.94, 29.87),
    "Mozambique": (-18.67, 35.53),
    "Suriname": (3.92, -56.03),
    "Colombia": (4.57, -74.3),
    "Bolivia": (-16.29, -63.59),
    "Ecuador": (-1.83, -78.18),
    "Venezuela": (6.42, -66.59),
    "Cuba": (21.52, -77.78),
    "Yemen": (15.55, 48.52),
    "Saudi Arabia": (23.89, 45.08),
    "Oman": (21.51, 55.92),
    "UAE": (23.42, 53.85),
    "Iraq": (33.22, 43.68),
    "Syria": (34.8, 38.99),
    "Jordan": (30.59, 36.24),
    "Lebanon": (33.85, 35.86),
    "Israel": (31.05, 34.85),
    "Greece": (39.07, 21.82),
    "Italy": (41.87, 12.57),
    "Poland": (51.92, 19.14),
    "Romania": (45.94, 24.97),
    "Serbia": (44.02, 21.01),
    "Bulgaria": (42.73, 25.49),
    "Czech Republic": (49.82, 15.47),
    "Slovakia": (48.67, 19.7),
    "Hungary": (47.16, 19.5),
    "Austria": (47.52, 14.55),
    "Switzerland": (46.82, 8.23),
    "Belgium": (50.5, 4.47),
    "Netherlands": (52.13, 5.29),
    "New Zealand": (-40.9, 174.89),
    "Papua New Guinea": (-6.31, 143.96),
    "Fiji": (-17.71, 178.07),
    "Jamaica": (18.11, -77.3),
    "Latin America": (-15.0, -65.0),
    "South America": (-15.0, -65.0),
    "Africa": (0.0, 25.0),
    "Asia": (35.0, 85.0),
    "Europe": (52.0, 15.0),
    "Greenland": (71.71, -42.6),
    "Iceland": (64.96, -19.02),
}

# Names that are trusted to mean one deposit, and the countries it may lie in.
TRUSTED = {
    "bushveld": ("south africa",),
    "witwatersrand": ("south africa",),
    "merensky": ("south africa",),
    "sishen": ("south africa",),
    "palabora": ("south africa",),
    "jwaneng": ("botswana",),
    "orapa": ("botswana",),
    "kalgoorlie": ("australia",),
    "kambalda": ("australia",),
    "olympic dam": ("australia",),
    "mount isa": ("australia",),
    "broken hill": ("australia",),
    "mcarthur river": ("australia",),
    "century mine": ("australia",),
    "northparkes": ("australia",),
    "telfer": ("australia",),
    "jundee": ("australia",),
    "sunrise dam": ("australia",),
    "cadia": ("australia",),
    "prominent hill": ("australia",),
    "jiaodong": ("china",),
    "linglong": ("china",),
    "sanshandao": ("china",),
    "dexing": ("china",),
    "bayan obo": ("china",),
    "yulong": ("china",),
    "qulong": ("china",),
    "jiama": ("china",),
    "daye": ("china",),
    "jinchuan": ("china",),
    "norilsk": ("russia",),
    "muruntau": ("uzbekistan",),
    "kumtor": ("kyrgyzstan",),
    "geita": ("tanzania",),
    "obuasi": ("ghana",),
    "ahafo": ("ghana",),
    "akyem": ("ghana",),
    "kibali": ("dr congo", "democratic republic of the congo",),
    "kamoa": ("dr congo", "democratic republic of the congo",),
    "kansanshi": ("zambia",),
    "lumwana": ("zambia",),
    "tenke": ("dr congo",),
    "loulo": ("mali",),
    "tasiast": ("mauritania",),
    "sudbury": ("canada",),
    "voisey": ("canada",),
    "kidd creek": ("canada",),
    "hemlo": ("canada",),
    "red lake": ("canada",),
    "malartic": ("canada",),
    "detour": ("canada",),
    "oyu tolgoi": ("mongolia",),
    "erdenet": ("mongolia",),
    "tavan tolgoi": ("mongolia",),
    "chuquicamata": ("chile",),
    "escondida": ("chile",),
    "collahuasi": ("chile",),
    "los pelambres": ("chile",),
    "antamina": ("peru",),
    "yanacocha": ("peru",),
    "cerro verde": ("peru",),
    "las bambas": ("peru",),
    "grasberg": ("indonesia",),
    "batu hijau": ("indonesia",),
    "porgera": ("papua new guinea",),
    "lihir": ("papua new guinea",),
    "kiruna": ("sweden",),
    "boliden": ("sweden",),
    "neves-corvo": ("portugal",),
    "lubin": ("poland",),
    "kupferschiefer": ("poland", "germany",),
    "sarcheshmeh": ("iran",),
    "sungun": ("iran",),
    "fore-sudetic": ("poland",),
    "pine creek": ("australia",),
    "kibaran": ("dr congo", "rwanda", "burundi", "tanzania",),
    "quadrilatero": ("brazil",),
    "carajas": ("brazil",),
}

# Deposits of known place: latitude, longitude, country.
CURATED = {
    "Kalgoorlie": (-30.75, 121.47, "Australia"),
    "Olympic Dam": (-30.44, 136.89, "Australia"),
    "Mount Isa": (-20.73, 139.49, "Australia"),
    "Broken Hill": (-31.96, 141.47, "Australia"),
    "McArthur River": (-16.44, 136.08, "Australia"),
    "Ernest Henry": (-20.38, 140.74, "Australia"),
    "Bushveld Complex": (-25.0, 28.5, "South Africa"),
    "Witwatersrand": (-26.2, 27.8, "South Africa"),
    "Jiaodong": (37.5, 120.5, "China"),
    "Bayan Obo": (41.8, 109.97, "China"),
    "Norilsk": (69.33, 88.22, "Russia"),
    "Muruntau": (41.52, 64.58, "Uzbekistan"),
    "Kumtor": (41.83, 78.22, "Kyrgyzstan"),
    "Obuasi": (6.2, -1.68, "Ghana"),
    "Geita": (-2.87, 32.23, "Tanzania"),
    "Kamoa-Kakula": (-10.73, 25.78, "DR Congo"),
    "Kansanshi": (-12.07, 25.85, "Zambia"),
    "Loulo-Gounkoto": (13.67, -10.72, "Mali"),
    "Oyu Tolgoi": (43.0, 106.85, "Mongolia"),
    "Grasberg": (-4.05, 137.12, "Indonesia"),
    "Batu Hijau": (-8.97, 116.87, "Indonesia"),
    "Porgera": (-5.47, 143.13, "Papua New Guinea"),
    "Lihir": (-3.12, 152.63, "Papua New Guinea"),
    "Neves-Corvo": (37.6, -7.93, "Portugal"),
    "Kiruna": (67.85, 20.25, "Sweden"),
    "Lubin": (51.4, 16.2, "Poland"),
    "Fore-Sudetic Monocline": (51.3, 16.5, "Poland"),
    "Sarcheshmeh": (29.76, 55.74, "Iran"),
    "Yanacocha": (-7.0, -78.5, "Peru"),
    "Antamina": (-9.33, -77.07, "Peru"),
    "Las Bambas": (-14.2, -72.2, "Peru"),
    "Cerro Verde": (-16.53, -71.56, "Peru"),
    "Carajas": (-6.06, -50.28, "Brazil"),
    "Quadrilátero Ferrífero": (-20.0, -43.5, "Brazil"),
    "Dexing": (29.01, 117.68, "China"),
    "Jinchuan": (38.5, 102.17, "China"),
}

# Belts: latitude, longitude, country, other names.
ALIAS_BELTS = {
    "闽西南成矿带": (25.5, 116.5, "China", ("福建西南部铁多金属成矿带", "Southwestern Fujian metallogenic belt", "SFMB", "华夏地块，闽西南", "永安-梅州坳陷带",)),
    "沁水盆地": (36.0, 112.5, "China", ("沁水盆地南部", "Qinshui Basin", "Qinshui Coalfield",)),
    "鄂尔多斯盆地": (38.0, 108.0, "China", ("Ordos Basin", "鄂尔多斯盆地", "四川盆地川西坳陷",)),
    "四川盆地": (30.0, 104.5, "China", ("Sichuan Basin", "四川盆地西部", "川西坳陷",)),
    "渤海湾盆地": (38.5, 118.0, "China", ("黄骅坳陷", "Huanghua Depression", "Bohai Bay Basin", "黄骅坳陷，渤海湾盆地",)),
    "松辽盆地": (47.0, 125.0, "China", ("Songliao Basin", "松辽盆地北部", "徐家围子断陷",)),
    "准噶尔盆地": (44.5, 86.5, "China", ("Junggar Basin", "准噶尔盆地南缘",)),
    "胶东金矿带": (37.0, 121.0, "China", ("胶东金矿成矿带", "Jiaodong Gold Belt", "华北克拉通东南缘",)),
    "南岭成矿带": (25.0, 113.0, "China", ("Nanling metallogenic belt", "华南地区",)),
    "长江中下游成矿带": (30.5, 117.0, "China", ("Middle-Lower Yangtze River Valley", "中下游成矿带", "Yangtze River Valley metallogenic belt",)),
    "大兴安岭成矿带": (46.0, 119.5, "China", ("大兴安岭中南部", "Ag多金属成矿带", "大兴安岭",)),
    "西昆仑造山带": (37.0, 79.0, "China", ("Western Kunlun Orogenic Belt", "Dahongliutan",)),
    "义敦岛弧带": (30.0, 99.0, "China", ("Yidun-Zhongdian", "Ganze-Litang", "义敦-中甸岛弧带",)),
    "阿尔泰成矿带": (47.0, 89.0, "China", ("Fuyun", "Altai", "southern Altai region", "Siberian Plate",)),
    "江南造山带": (27.0, 112.0, "China", ("雪峰山造山带", "Xuefengshan Orogen", "Jiangnan Orogenic Belt",)),
    "莺歌海盆地": (18.0, 109.5, "China", ("Yinggehai Basin", "莺歌海",)),
    "贵州西部成矿区": (26.5, 104.5, "China", ("Eastern Yunnan and Western Guizhou", "贵州西部", "土城向斜", "滇黔桂", "盘关向斜",)),
    "乌尔米耶-多赫塔尔岩浆弧": (35.5, 48.5, "Iran", ("Urumieh-Dokhtar magmatic arc", "UDMA", "Ahar-Arasbaran porphyry copper belt", "Ahar-Arasbaran",)),
    "莫阿勒曼-托巴特带": (35.5, 59.0, "Iran", ("Moaleman–Torbat-e-Heydaryeh belt", "NE Iran", "Moaleman",)),
    "扎格罗斯褶皱冲断带": (31.0, 48.5, "Iran", ("Zagros Folded and Thrusted Belt", "ZFTB", "Zagros fold-thrust belt", "Abadan Plain", "Mesopotamian Basin", "Gavbendi High",)),
    "马拉叶尔-伊斯法罕带": (33.0, 51.0, "Iran", ("Malayer-Esfahan metallogenic belt", "Sanandaj-Sirjan zone", "Sanandaj-Sirjan",)),
    "巴夫克成矿带": (32.0, 55.5, "Iran", ("Bafq metallogenic belt", "Central Iran", "Bafq",)),
    "麦古马地体": (44.5, -64.0, "Canada", ("Meguma Terrane", "Nova Scotia", "Meguma",)),
    "阿比蒂比绿岩带": (49.0, -79.0, "Canada", ("Abitibi Subprovince", "Superior Province", "Wabigoon Subprovince", "Matheson",)),
    "跨哈德森造山带": (58.0, -98.0, "Canada", ("Trans-Hudson Orogen", "Churchill Province", "Trans-Hudson",)),
    "格伦维尔省": (57.0, -104.0, "Canada", ("Grenville Province", "Athabasca Basin", "Athabasca",)),
    "威利斯顿盆地": (47.0, -102.0, "USA", ("Williston Basin", "Bakken Formation", "Williston",)),
    "伊比利亚黄铁矿带": (37.5, -8.0, "Spain", ("Iberian Pyrite Belt", "South Portuguese Zone", "Hercynian Iberian Massif", "Iberian Variscan Belt", "Iberian",)),
    "上莱茵地堑": (49.0, 8.0, "Germany", ("Upper Rhine Graben", "Rhine Graben",)),
    "芬诺斯坎的亚地盾": (65.0, 26.0, "Finland", ("Fennoscandian Shield", "Fennoscandian",)),
    "苏伊士湾裂谷盆地": (29.0, 33.0, "Egypt", ("Gulf of Suez Rift basin", "Gulf of Suez",)),
    "依利兹盆地": (28.0, 9.0, "Algeria", ("Illizi Basin", "Illizi",)),
    "尼日尔三角洲": (5.0, 6.0, "Nigeria", ("Niger Delta",)),
    "伏尔塔盆地": (9.0, -1.0, "Ghana", ("Volta Basin", "West African Craton",)),
    "曼达瓦盆地": (-9.0, 39.0, "Tanzania", ("Mandawa Basin", "Tanga盆地", "Tanga Basin",)),
    "布雷达斯多普盆地": (-34.5, 21.0, "South Africa", ("Bredasdorp Basin", "Outeniqua Basin",)),
    "卡拉哈里盆地": (-22.0, 26.0, "Botswana", ("Kalahari Karoo Basin", "Karoo Supergroup", "Kalahari",)),
    "卡普瓦尔克拉通": (-26.0, 28.0, "South Africa", ("Kaapvaal Craton", "Kaapvaal",)),
    "中非元古代造山带": (-2.0, 30.0, "Rwanda", ("Mesoproterozoic orogenic belts of Central Africa", "Central Africa orogenic",)),
    "萨永-马西拉盆地": (15.5, 48.5, "Yemen", ("Sayun-Masila Rift Basin", "Sayun-Masila",)),
    "楚-萨雷苏盆地": (45.0, 66.0, "Kazakhstan", ("Chu-Sarysu Basin", "Ustyurt–Buzachi Basin", "Ustyurt-Buzachi", "Ustyurt",)),
    "印度河盆地": (27.0, 68.0, "Pakistan", ("Middle Indus Basin", "Lower Indus Basin", "Indus Basin", "Southern Indus Basin", "Upper Indus Basin", "Potwar Plateau", "Dargai Complex", "Indus Suture Zone",)),
    "孟买近海盆地": (19.0, 72.0, "India", ("Mumbai offshore basin", "Heera–Panna–Bassein", "Heera-Panna-Bassein",)),
    "坎贝盆地": (22.0, 73.0, "India", ("Cambay Basin", "Jambusar–Broach block", "Jambusar-Broach",)),
    "克里希纳-戈达瓦里盆地": (16.0, 81.0, "India", ("Krishna-Godavari Basin", "Krishna-Godavari",)),
    "鲍恩盆地": (-23.0, 148.0, "Australia", ("Bowen Basin", "Central Queensland",)),
    "拉赫兰造山带": (-35.0, 148.0, "Australia", ("Lachlan Orogen", "Lachlan",)),
    "塔拉纳基盆地": (-39.0, 174.0, "New Zealand", ("Taranaki Basin", "Taranaki",)),
    "圭亚那地盾绿岩带": (4.0, -56.0, "Suriname", ("Guiana Shield", "圭亚那地盾",)),
}


def centroids(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, c, float(a), float(b)) for k, (c, (a, b)) in enumerate(CENTROIDS.items())], "ord int, country string, lat double, lon double")


def trusted(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, list(v)) for k, v in TRUSTED.items()], "keyword string, countries array<string>")


def curated(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, n, float(a), float(b), c) for k, (n, (a, b, c)) in enumerate(CURATED.items())], "ord int, name string, lat double, lon double, country string")


def alias_belts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, n, float(a), float(b), c, list(x)) for k, (n, (a, b, c, x)) in enumerate(ALIAS_BELTS.items())], "ord int, name string, lat double, lon double, country string, alias array<string>")


def from_file(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A larger table from JSON lines: kind belts (ord, name, lat, lon), deposits (and country, type) or boxes."""
    from ..sources.readers import read_dimension

    schemas = {
        "belts": ("ord int, name string, lat double, lon double", "name"),
        "deposits": ("ord int, name string, lat double, lon double, country string, type string", "name"),
        "boxes": ("ord int, country string, lat_lo double, lat_hi double, lon_lo double, lon_hi double", "country"),
    }
    return read_dimension(spark, path, *schemas[kind])


def append(entries: DataFrame, path: str) -> None:
    """Add entries to a table's file; of equal names the one with the greater ord counts when it is read."""
    entries.write.mode("append").json(path)
