"""Default parameters and message texts of the traffic operators."""

# Thresholds and periods of the traffic rules.
OVERSPEED_FACTOR = 1.1
SEVERE_FACTOR = 1.2
DEFAULT_SPEED_LIMIT = 60
REPEAT_GAP_MS = 10_000
PATTERN_SPAN_MS = 120_000
MATCH_TOLERANCE_MS = 5_000
AVERAGE_SIZE_MS = 300_000
AVERAGE_SLIDE_MS = 60_000
TOP_SLIDE_MS = 120_000
TOP_K = 3
AREA_WINDOW_MS = 10_000
WATERMARK_DELAY = "5 seconds"
NO_DELAY = "0 seconds"
DAY_MS = 86_400_000
MAX_LONG = 9_223_372_036_854_775_807

# Message texts and their formats.
REPEAT_MESSAGE = "存在套牌嫌疑"
DANGER_HEAD = "危险驾驶：%s : "
DANGER_EVENT = "危险驾驶车辆：OutOfLimitSpeedInfo(%s,%s,%s,%s,%s,%s) --"
REPORT_HEAD = "在窗口‘%s---%s’时间范围内，整个城市最堵的前3卡口是：\n\r"
REPORT_LINE = "卡口：%s，经过的车辆数量：%s,平均车速：%s \n\r"
