"""Fixed values that must equal the published ones for results to agree."""

# Text that counts as true (compared in lower case, untrimmed).
TRUE_WORDS = ("true", "t", "on", "1")

# Characters that trimming removes.
_BLANK_POINTS = (9, 10, 11, 12, 13, 32, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)
WHITESPACE = "".join(map(chr, _BLANK_POINTS))
BLANK = "".join(f"\\x{{{point:X}}}" for point in _BLANK_POINTS)  # the same, for use inside a regular expression class

# Category numbers and names.
CATEGORY_NAMES = {1: "RDBMS", 2: "BigDataNoSQL", 3: "FileAPI", 4: "CRMERP", 5: "Marketing"}
UNKNOWN_CATEGORY = -1

# Connector subtypes of each category.
_SUBTYPES = {
    1: [
        "postgres", "postgresql", "mysql", "mssql", "sqlserver", "oracle", "mariadb", "db2", "sqlite", "sybase",
        "teradata",
    ],
    2: [
        "databricks", "snowflake", "lakehouse", "redshift", "bigquery", "athena", "synapse", "trino", "presto",
        "hive", "cassandra", "mongodb",
    ],
    3: [
        "csv", "json", "parquet", "avro", "orc", "xml", "excel", "sftp", "ftp", "ftps", "box", "s3", "azureblob",
        "azuredatalakestorage", "azuredatalakestoragegen2", "googlecloudstorage", "googledrive", "onedrive",
        "sharepoint", "dropbox",
    ],
    4: [
        "salesforce", "dynamics", "dynamics365", "sap", "netsuite", "oracle_erp", "workday", "servicenow", "zendesk",
        "jira",
    ],
    5: [
        "mailchimp", "hubspot", "googleanalytics", "googleads", "facebookads", "linkedinads", "marketo", "pardot",
        "klaviyo", "sendgrid",
    ],
}
CONNECTOR_CATEGORIES = {word: number for number, words in _SUBTYPES.items() for word in words}

# Run states of the two published vocabularies, mapped to one.
STATUS_WORDS = {
    "success": "success",
    "successful": "success",
    "failed": "failed",
    "running": "running",
    "stopped": "stopped",
    "pending": "pending",
}

# Columns that hold a name, a type or a project reference.
NAME_FIELDS = ("name", "connectorName", "pipelineName", "automationName", "projectName")
TYPE_FIELDS = ("type", "connectorType", "pipelineType", "automationType")
PROJECT_FIELDS = ("projectId", "internalID", "project")

# Numbers of the screens of a configuration, what each builds on, and which exclude each other.
SCREENS = {1: "catalogs", 2: "artifacts", 6: "database", 7: "schema"}
SCREEN_NEEDS = {2: (1, 7), 6: (7,), 7: (1, 6)}
SCREEN_CONFLICTS = ((1, 6),)

# Ingestion types, and the mode words that mean one of them or a plain write.
INGESTION_TYPES = ("cdc", "delta", "historical", "snapshot", "stored_procedure")
MODE_WORDS = {
    "incremental": "delta",
    "full_refresh": "overwrite",
    "full": "overwrite",
    "upsert": "upsert",
    "append": "append",
    "overwrite": "overwrite",
    "cdc": "cdc",
}
