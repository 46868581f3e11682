"""Fixed schemas and lookup values: what the feeds look like and what the tables hold."""

from pyspark.sql.types import (
    BinaryType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


# Full English month names, in calendar order.
MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]

# Source column type -> warehouse column type.
WAREHOUSE_TYPES = {
    "int": "INTEGER",
    "tinyint": "INTEGER",
    "smallint": "INTEGER",
    "bigint": "INTEGER",
    "varchar": "STRING",
    "char": "STRING",
    "text": "STRING",
    "longtext": "STRING",
    "double": "FLOAT",
    "float": "FLOAT",
    "decimal": "FLOAT",
    "datetime": "TIMESTAMP",
}

# What a source type outside WAREHOUSE_TYPES becomes.
FALLBACK_WAREHOUSE_TYPE = "STRING"

# Warehouse column type -> Spark type used for the copied column.
SPARK_TYPES = {
    "INTEGER": LongType(),
    "STRING": StringType(),
    "FLOAT": DoubleType(),
    "TIMESTAMP": TimestampType(),
}

# Operator labels written to the bill tables.
MAXIS = "MAXIS"
CELCOM = "CELCOM"

# Landing folders below the source root.
EMPLOYEE_FOLDER = "Employee_data/"
ITEMIZED_FOLDER = "Maxis_data/Itemized_bill/"
MAXIS_MONTHLY_FOLDER = "Maxis_data/MonthlyBillData/"
CELCOM_MONTHLY_FOLDER = "CelcomData/"

# Columns of an itemized bill file.
ITEMIZED_CSV = StructType([
    StructField(name, StringType(), True)
    for name in [
        "Calling Number", "Date", "Time", "Type", "From", "To", "Operator",
        "PhoneNumber", "NumberCalled", "Quantity", "Size", "Duration", "Period",
        "GrossAmount", "Discount", "Total", "Call Type",
    ]
])

# Headers of the staff list.
EMPLOYEE_HEADERS = [
    "H/P NO.", "User / Custodian (As per HR list)", "USER", "Phone Model", "Refresh",
    "Location", "Deliver Date", "Provider", "Type", "Custodian", "Cost Center",
    "Department", "Department HR ", "Title", "Supervisor", "Head Of Department",
]

# Headers of a CELCOM bill.
CELCOM_HEADERS = [
    "Mobile No", "Account No", "Child Account No", "Credit Limit", "Monthly Charges",
    "Usage Call/Charges", "One Time Charges", "Discount and Rebates",
    "Current Charges (Excl Tax)",
]

SHEET_ROWS = _schema(
    path=StringType(),
    sheet=StringType(),
    sheet_index=IntegerType(),
    row=IntegerType(),
    cells=MapType(IntegerType(), StringType()),
)

BINARY_FILES = _schema(
    path=StringType(),
    modificationTime=TimestampType(),
    length=LongType(),
    content=BinaryType(),
)

# Columns of the bill, staff and mart tables.
ITEMIZED_BILL = _schema(
    phone_number=LongType(),
    STD_code=StringType(),
    start_date=DateType(),
    end_date=DateType(),
    time=StringType(),
    call_type=StringType(),
    calling_network=StringType(),
    called_network=StringType(),
    roaming_operator=StringType(),
    incoming_number=StringType(),
    outgoing_number=LongType(),
    quantity=IntegerType(),
    size=StringType(),
    duration=StringType(),
    period=StringType(),
    gross_amount=DoubleType(),
    discount=DoubleType(),
    total=DoubleType(),
    charges_type=StringType(),
    billing_month=StringType(),
    billing_year=IntegerType(),
    operator=StringType(),
)

MONTHLY_BILL_SUMMARY = _schema(
    operator=StringType(),
    phone_number=LongType(),
    STD_code=StringType(),
    account_number=LongType(),
    employee_account_number=LongType(),
    credit_limit=DoubleType(),
    base_charges=DoubleType(),
    value_added_service=DoubleType(),
    usage_charges=DoubleType(),
    other_charges=DoubleType(),
    discount=DoubleType(),
    total=DoubleType(),
    billing_month=StringType(),
    billing_year=IntegerType(),
)

EMPLOYEE_MASTER = _schema(
    STD_code=StringType(),
    contact_number=LongType(),
    username=StringType(),
    phone_model=StringType(),
    refresh=StringType(),
    location=StringType(),
    deliver_date=StringType(),
    provider=StringType(),
    type=StringType(),
    custodian=StringType(),
    user_custodian=StringType(),
    cost_center=StringType(),
    department=StringType(),
    department_HR=StringType(),
    title=StringType(),
    supervisor=StringType(),
    head_of_department=StringType(),
)

EMPLOYEE_ITEMIZED_BILL = _schema(
    phone_number=LongType(),
    username=StringType(),
    location=StringType(),
    cost_center=StringType(),
    department=StringType(),
    supervisor=StringType(),
    head_of_department=StringType(),
    operator=StringType(),
    start_date=DateType(),
    end_date=DateType(),
    time=StringType(),
    duration=StringType(),
    quantity=IntegerType(),
    size=StringType(),
    call_type=StringType(),
    type=StringType(),
    incoming_number=StringType(),
    outgoing_number=LongType(),
    gross_amount=DoubleType(),
    discount=DoubleType(),
    total=DoubleType(),
    charges_type=StringType(),
    billing_month=StringType(),
    billing_year=IntegerType(),
)

EMPLOYEE_MONTHLY_TOP = _schema(
    phone_number=LongType(),
    username=StringType(),
    location=StringType(),
    cost_center=StringType(),
    department=StringType(),
    supervisor=StringType(),
    head_of_department=StringType(),
    operator=StringType(),
    base_charges=DoubleType(),
    value_added_service=DoubleType(),
    usage_charges=DoubleType(),
    other_charges=DoubleType(),
    discount=DoubleType(),
    total=DoubleType(),
    billing_month=StringType(),
    billing_year=IntegerType(),
)

# Headerless activity export: square, epoch millis, country, five activity measures.
ACTIVITY_TSV = _schema(
    _c0=LongType(),
    _c1=LongType(),
    _c2=LongType(),
    _c3=DoubleType(),
    _c4=DoubleType(),
    _c5=DoubleType(),
    _c6=DoubleType(),
    _c7=DoubleType(),
)

# Measures of an activity slot.
ACTIVITY_MEASURES = [
    "SMS_in_activity",
    "SMS_out_activity",
    "call_in_activity",
    "call_out_activity",
    "internet_traffic_activity",
]
