"""Hand-made messy candle table covering each null and coercion trap."""

MESSY_CSV = """symbol,interval,open_time,open,high,low,close,volume,close_time,quote_volume,trade_count
BTCUSDT,1h,2026-06-29T00:00:00+00:00,100,110,95,105,10,2026-06-29T00:59:59.999000+00:00,1000,50
 BTCUSDT ,1h,2026-06-29T00:00:00+00:00,100,110,95,105,10,2026-06-29T00:59:59.999000+00:00,1000,50
btc/usdt,1h,2026-06-29T01:00:00+00:00,105,107,99,100,20,2026-06-29T01:59:59.999000+00:00,2000,60
ETHUSDT,1h,2026-06-29T00:00:00+00:00,10,12,9,11,,2026-06-29T00:59:59.999000+00:00,300,30
ETHUSDT,1h,2026-06-29T01:00:00+00:00,11,12,10,12,-5,2026-06-29T01:59:59.999000+00:00,300,30
ETHUSDT,1h,2026-06-29T02:00:00+00:00,12,13,11,13,5,2026-06-29T02:59:59.999000+00:00,300,-1
SOLUSDT,1h,2026-06-29T00:00:00+00:00,5,4,6,5,7,2026-06-29T00:59:59.999000+00:00,35,7
SOLUSDT,1h,2026-06-29T01:00:00+00:00,unknown,6,4,5,8,2026-06-29T01:59:59.999000+00:00,40,8
SOLUSDT,1h,not_a_date,5,6,4,5.5,9,2026-06-29T02:59:59.999000+00:00,45,9
SOLUSDT,1h,missing_time,5,6,4,5.5,9,2026-06-29T02:59:59.999000+00:00,45,9
XRPUSDT,1h,2026-06-29T00:00:00+00:00,0,2,0,1,3,2026-06-29T00:59:59.999000+00:00,3,3
XRPUSDT,1h,2026-06-29T01:00:00+00:00,1,1,1,1,4,2026-06-29T01:59:59.999000+00:00,-7,4
ADAUSDT,1h,2026-06-29T00:00:00+00:00,1,2,1,2,1d,2026-06-29T00:59:59.999000+00:00,6,6
"""


def write_messy(tmp_dir: str) -> str:
    path = f"{tmp_dir}/messy.csv"
    with open(path, "w") as f:
        f.write(MESSY_CSV)
    return path
