"""The datasets that the library knows, by name."""

from __future__ import annotations

from tidemill.catalog import github, jira, marts, servicenow, sonarqube
from tidemill.spec import Dataset

DATASETS: dict[str, Dataset] = {d.name: d for group in (github, servicenow, sonarqube, jira, marts) for d in group.DATASETS}
