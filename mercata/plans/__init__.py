"""The jobs: generating batches, staging, auditing, building the mart and reading its views."""
