from .files import (read_flow_raw, read_incident_raw, read_json_documents, read_json_records,
                    read_layer)
from .jdbc import read_serving, read_serving_or_empty

__all__ = ["read_flow_raw", "read_incident_raw", "read_json_documents",
           "read_json_records", "read_layer", "read_serving", "read_serving_or_empty"]
