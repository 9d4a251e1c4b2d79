"""User-facing screens, the sideways job, diagnostics and coverage reports."""
