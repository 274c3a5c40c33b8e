"""Fixed values.

Constants whose exact text or number must equal the source system's for
results to match: audit labels, date layouts, the report request layout,
the workbook layout and the patterns read from responses and pages. They
are stated here together, in the order the data flows through them.
"""

# Run status labels written to the audit log.
RUN_OK = "OK"
RUN_FAIL = "FAIL"
RUN_NO_UPDATE = "No Update"

# Portal index page: line stating the data version, and the placeholder
# entry of its drop-down lists.
VERSION_PATTERN = (r"Fecha de actualización de los datos:\s+"
                   r"(\d{1,2}/\d{1,2}/\d+\s+\d{1,2}:\d{1,2}:\d{1,2}\s+\w+)")
PLACEHOLDER = "Seleccione"

# Report request: query-string layout around the two encoded names.
REPORT_QUERY_LAYOUT = "?&Ne={institution}&N=&A=&C=&E={status}"

# Response header: file name of the workbook.
FILE_NAME_PATTERN = r'filename="(.*?).xlsx"'

# Workbook layout (1-based rows and cells): banner date in row 3, cell 5 of
# the first sheet; header in row 5; data from row 6.
FIRST_SHEET = 1
BANNER_ROW = 3
BANNER_CELL = 5
HEADER_ROW = 5
FIRST_DATA_ROW = 6
BANNER_DATE_PATTERN = r".*?:\s+(\d{2}/\d{2}/\d{4}\s+\d{1,2}:\d{1,2}:\d{1,2}\s+\w{2})"
ACCENTED_ID_HEADER = "cédula"

# Date layouts: report times are day/month/year with a 12-hour clock and an
# AM/PM marker (a 24-hour reading is the fallback for hours above 12); start
# dates are day/month/year.
DATE_12H = "d/M/yyyy h:mm:ss a"
DATE_24H = "d/M/yyyy H:mm:ss a"
START_DATE_FORMAT = "d/M/yyyy"
