"""Fixed values of the public-health domain.

Everything in this module is data that results depend on: names, spellings, labels, band edges and
text patterns. Nothing here is logic; other domains pass their own values to the same operators.
"""

from __future__ import annotations

# --- fixed values: the 50 districts in scope -------------------------------------------------
DISTRICTS: tuple[str, ...] = (
    "พระนคร", "ดุสิต", "หนองจอก", "บางรัก", "บางเขน", "บางกะปิ", "ปทุมวัน", "ป้อมปราบศัตรูพ่าย",
    "พระโขนง", "มีนบุรี", "ลาดกระบัง", "ยานนาวา", "สัมพันธวงศ์", "พญาไท", "ธนบุรี", "บางกอกใหญ่",
    "ห้วยขวาง", "คลองสาน", "ตลิ่งชัน", "บางกอกน้อย", "บางขุนเทียน", "ภาษีเจริญ", "หนองแขม",
    "ราษฎร์บูรณะ", "บางพลัด", "ดินแดง", "บึงกุ่ม", "สาทร", "บางซื่อ", "จตุจักร", "บางคอแหลม",
    "ประเวศ", "คลองเตย", "สวนหลวง", "จอมทอง", "ดอนเมือง", "ราชเทวี", "ลาดพร้าว", "วัฒนา", "บางแค",
    "หลักสี่", "สายไหม", "คันนายาว", "สะพานสูง", "วังทองหลาง", "คลองสามวา", "บางนา", "ทวีวัฒนา",
    "ทุ่งครุ", "บางบอน",
)

# --- fixed values: spellings of district names -----------------------------------------------
DISTRICT_ALIASES: dict[str, str] = {
    "ป้อมปราบฯ": "ป้อมปราบศัตรูพ่าย",
    "ป้อมปราบ": "ป้อมปราบศัตรูพ่าย",
    "สัมพันธวงษ์": "สัมพันธวงศ์",
    "บางกอกไหญ่": "บางกอกใหญ่",
    "ราษฏร์บูรณะ": "ราษฎร์บูรณะ",
    "พระโขนg": "พระโขนง",
}
DENOMINATOR_DISTRICT_ALIASES: dict[str, str] = {
    "ป้อมปราบฯ": "ป้อมปราบศัตรูพ่าย",
    "ป้อมปราบ": "ป้อมปราบศัตรูพ่าย",
    "สัมพันธวงษ์": "สัมพันธวงศ์",
}

# --- fixed values: repairs of a district name, applied in this order (pattern, replacement) ---
DISTRICT_PREFIX = r"^(เขต|ข\.?)\s*"
LOCAL_OFFICE_PREFIX = r"^ท้องถิ่น"
CITY_SUFFIX = r"\s*(กรุงเทพมหานคร|กรุงเทพฯ|กทม\.?)\z"
SPLIT_VOWEL = ("เเ", "แ")
DOUBLED_MARK = (r"([ัิ-ฺ็-๎])\1+", "$1")

# --- fixed values: disease spellings ---------------------------------------------------------
DISEASE_ALIASES: dict[str, str] = {
    "ไข้เลือดออก": "ไข้เลือดออก",
    "โรคไข้เลือดออก": "ไข้เลือดออก",
    "dengue": "ไข้เลือดออก",
    "denguefever": "ไข้เลือดออก",
    "ไข้เด็งกี่ (Dengue fever)": "ไข้เลือดออก",
    "ไข้เลือดออก (DHF)": "ไข้เลือดออก",
    "ไข้เลือดออกช็อค (DSS)": "ไข้เลือดออก",
    "ไข้หวัดใหญ่": "ไข้หวัดใหญ่",
    "โรคไข้หวัดใหญ่": "ไข้หวัดใหญ่",
    "influenza": "ไข้หวัดใหญ่",
    "flu": "ไข้หวัดใหญ่",
    "มือเท้าปาก": "โรคมือเท้าปาก",
    "โรคมือเท้าปาก": "โรคมือเท้าปาก",
    "hfmd": "โรคมือเท้าปาก",
    "โควิด19": "โควิด-19",
    "โควิด-19": "โควิด-19",
    "covid19": "โควิด-19",
    "covid-19": "โควิด-19",
    "โรคโควิด-19": "โควิด-19",
    "โควิด-19 (COVID-19)": "โควิด-19",
    "ติดเชื้อไวรัสโคโรนา 2019 (covid-19)": "โควิด-19",
    "โรคติดเชื้อไวรัสโคโรนา 2019": "โควิด-19",
    "อุจจาระร่วง": "อุจจาระร่วงเฉียบพลัน",
    "โรคอุจจาระร่วง": "อุจจาระร่วงเฉียบพลัน",
    "อุจจาระร่วงเฉียบพลัน": "อุจจาระร่วงเฉียบพลัน",
    "โรคอุจจาระร่วงเฉียบพลัน": "อุจจาระร่วงเฉียบพลัน",
    "diarrhea": "อุจจาระร่วงเฉียบพลัน",
    "acutediarrhea": "อุจจาระร่วงเฉียบพลัน",
    "ปอดบวม": "ปอดบวม",
    "โรคปอดบวม": "ปอดบวม",
    "ปอดอักเสบ": "ปอดบวม",
    "โรคปอดอักเสบ": "ปอดบวม",
    "pneumonia": "ปอดบวม",
    "โรคปอดอักเสบหรือโรคปอดบวม": "ปอดบวม",
    "วัณโรค": "วัณโรค",
    "tuberculosis": "วัณโรค",
    "tb": "วัณโรค",
}

# --- fixed values: sex -----------------------------------------------------------------------
SEX_ALIASES: dict[str, str] = {
    "m": "M", "male": "M", "ชาย": "M", "1": "M",
    "f": "F", "female": "F", "หญิง": "F", "2": "F",
}
SEX_UNKNOWN = "U"
SEX_LABELS: dict[str, str] = {"M": "ชาย", "F": "หญิง", "U": "ไม่ระบุ"}

# --- fixed values: age bands (key, label, lowest age, highest age) ----------------------------
AGE_BANDS: tuple[tuple[int, str, int | None, int | None], ...] = (
    (1, "0-4", 0, 4),
    (2, "5-9", 5, 9),
    (3, "10-14", 10, 14),
    (4, "15-24", 15, 24),
    (5, "25-34", 25, 34),
    (6, "35-44", 35, 44),
    (7, "45-54", 45, 54),
    (8, "55-64", 55, 64),
    (9, "65+", 65, None),
    (10, "ไม่ระบุ", None, None),
)
AGE_BAND_UNKNOWN = 10

# --- fixed values: month labels and the calendar offset --------------------------------------
MONTH_LABELS: tuple[str, ...] = (
    "ม.ค.", "ก.พ.", "มี.ค.", "เม.ย.", "พ.ค.", "มิ.ย.", "ก.ค.", "ส.ค.", "ก.ย.", "ต.ค.", "พ.ย.", "ธ.ค.",
)
BUDDHIST_OFFSET = 543

# --- fixed values: column spellings of raw files ---------------------------------------------
CASE_COLUMNS: dict[str, tuple[str, ...]] = {
    "case_id": ("case_id", "id", "patient_id", "record_id", "_id", "_record_id", "รหัสผู้ป่วย", "เลขที่ผู้ป่วย"),
    "report_date": ("report_date", "date", "reported_date", "onset_date", "วันที่รายงาน", "วันที่", "วันที่ป่วย",
                    "วันเริ่มป่วย", "วันที่เริ่มป่วย"),
    "year": ("year", "report_year", "ปี", "ปีข้อมูล", "ปีพ.ศ.", "พ.ศ."),
    "disease_name": ("disease_name", "disease", "disease_th", "diagnosis", "โรค", "ชื่อโรค", "ชื่อกลุ่มโรค",
                     "การวินิจฉัย"),
    "district_name": ("district_name", "district", "district_th", "area", "เขต", "ชื่อเขต", "อำเภอ/เขต", "พื้นที่"),
    "case_count": ("case_count", "cases", "count", "total_cases", "จำนวน", "จำนวนผู้ป่วย", "จำนวนราย"),
    "sex": ("sex", "gender", "เพศ"),
    "age": ("age", "patient_age", "อายุ", "อายุ (เต็ม) ปี"),
}
POPULATION_COLUMNS: dict[str, tuple[str, ...]] = {
    "year": ("year", "ปี", "ปีข้อมูล", "ปีพ.ศ.", "พ.ศ.", "_source_year"),
    "district_name": ("district_name", "district", "district_th", "เขต", "ชื่อเขต", "อำเภอ/เขต", "แขวง/เขต"),
    "population": ("population", "total_population", "ประชากร", "จำนวนประชากร", "ประชากรรวม", "รวมประชากร",
                   "ประชากรทั้งหมด", "ประชากรรวมทั้งสิ้น"),
}
OFFICIAL_POPULATION_COLUMNS: dict[str, tuple[str, ...]] = {
    "year": ("ปี", "ปีข้อมูล", "ปีพ.ศ.", "พ.ศ.", "year", "year_be"),
    "district_name": ("เขต", "ชื่อเขต", "อำเภอ/เขต", "district", "district_name", "ชื่อสำนักทะเบียน"),
    "population": ("ประชากรรวม", "ประชากรทั้งหมด", "จำนวนประชากร", "ประชากร", "total_population", "population",
                   "total", "จำนวนประชากรทั้งหมด"),
    "province": ("ชื่อจังหวัด", "จังหวัด", "province"),
}
CITY_PROVINCE = "กรุงเทพ"
TOTAL_ROW_PREFIX = r"^(รวม|ทั้งหมด|total)"
TOTAL_ROW_INFIX = "รวม"
TOTAL_ROW_NAMES = ("ทั้งหมด", "total")
NO_DISTRICT_MARKS = ("", "-")

# --- fixed values: raw file contract ---------------------------------------------------------
CASE_CSV_FIELDS: tuple[str, ...] = (
    "ชื่อกลุ่มโรค", "อายุ (เต็ม) ปี", "อายุ (เต็ม) เดือน", "อาย (เต็ม) วัน", "เพศ", "สถานภาพสมรส", "สัญชาติ",
    "อาชีพ", "จังหวัด", "อำเภอ/เขต", "ตำบล/แขวง", "วันที่เริ่มป่วย", "สภาพผู้ป่วย", "ประเภทผู้ป่วย", "สถานที่รักษา",
)
CASE_JSON_FIELDS: tuple[str, ...] = ("_id",) + CASE_CSV_FIELDS
POPULATION_FIELDS: tuple[str, ...] = ("ปี", "เขต", "ประชากรรวม")
ENVELOPE_KEYS: tuple[str, ...] = ("data", "records", "result", "results", "items")
CASE_FILE_PATTERN = r"disease_cases_(\d{4})_(full|sample)(?:_(\d{8}))?\.(csv|json)$"
CASE_FILE_YEAR_PATTERN = r"disease_cases_(\d{4})"

# --- fixed values: coverage texts ------------------------------------------------------------
COVERAGE_COMPLETE = "ครบถ้วน"
COVERAGE_PARTIAL = "ไม่มี/ไม่ครบ — แสดงเฉพาะจำนวนผู้ป่วย"
RECONCILED = "ตรงกัน"
NOT_RECONCILED = "ไม่ตรง"
