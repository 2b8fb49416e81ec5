"""Product lines: configurations and the plan that takes raw sales to published forecasts."""
