"""Published results for one monthly series of four years (fixed values)."""

import datetime

# monthly sales, January 2015 to December 2018
MONTHLY = [
    11610.125, 4054.348, 26407.42, 21905.435, 19241.675, 25476.8366, 23800.077, 23634.3025, 45800.5508, 24903.329,
    58779.1417, 48847.8545, 10230.972, 9721.963, 21752.534, 27822.0305, 22723.0425, 19106.087, 24618.225, 29090.0062,
    49321.216, 26376.384, 58024.9305, 53424.2032, 14669.789, 14047.073, 31733.283, 25712.933, 34413.77, 30951.941,
    31582.446, 25418.9923, 55283.1135, 30519.649, 59537.496, 68404.159, 24587.413, 17595.7594, 38629.1548, 25591.0531,
    36420.0042, 39990.4382, 36512.463, 40872.63, 66252.429, 46270.4812, 79650.479, 69614.4578,
]
SARIMA_HOLDOUT = (8982.024059358162, 9636.055811449169, 0.14298559155983204)
SARIMA_MONTHS = [33295.6775204922, 28171.677631312323, 47903.70666325719]
SARIMA_LOWER = [20616.893466061993, 15306.005786577314, 34821.09058742915]
SARIMA_UPPER = [45974.46157492241, 41037.34947604733, 60986.322739085226]
BOOSTED_HOLDOUT = (11464.485200000003, 12869.23707855699, 0.19846476847069236)
BOOSTED_MONTHS = [25042.9609375, 20423.119140625, 35791.078125]
ACF = {1: 0.3913, 2: 0.1591, 3: 0.2005, 12: 0.6387}
SEASONAL = [-16342.5, -19466.3, -3073.0, -7983.5, -3759.9, -5507.6, -4116.5, -5104.0, 18625.4, -4464.0, 26760.3, 24431.6]
TREND_ENDS = (27814.293, 43448.468)
ADF_P_VALUE = 0.0010


def months(start, count):
    year, month = start
    return [datetime.date(year + (month - 1 + i) // 12, (month - 1 + i) % 12 + 1, 1) for i in range(count)]


def monthly_rows():
    return list(zip(months((2015, 1), len(MONTHLY)), MONTHLY))
