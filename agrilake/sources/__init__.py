"""Reading and writing: reference data, landed payloads, lake layers, run metadata, warehouse tables."""
