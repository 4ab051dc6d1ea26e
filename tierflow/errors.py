"""Messages of failed jobs.

Fixed values: monitoring matches on these texts.
"""

ENVIRONMENT = "Error loading environment medallion configuration file: {cause}"
INGEST = "Error loading ingestion configuration file: {cause}"
CONNECTOR = "Error loading connector configuration file: {cause}"
LOAD_SOURCE = "Error loading data with the SQL statement: {sql}, error: {cause}"
WRITE_BRONZE = "Error writing data to the Bronze layer, error: {cause}"
LOAD_EVENTS = "Error loading and transforming event data from the Bronze layer, error: {cause}"
WRITE_EVENTS = "Error writing event data to the Silver layer, error: {cause}"
LOAD_DIMENSION = "Error loading dimension data from the Bronze layer, error: {cause}"
WRITE_DIMENSION = "Error writing dimension data to the Silver layer, error: {cause}"
