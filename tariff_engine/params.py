"""Run-time parameters of the pricing model.

Every model reads its knobs from one frozen ``PricingParams`` value; a
different run (a ``--vars`` style override) is just another value built
with :meth:`PricingParams.replace` or :meth:`PricingParams.from_vars`.
"""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass

ELECTRICITY = "ELECTRICITY"
GAS = "GAS"

# Fixed values (must equal the reference for identical results):
# accepted energy types, scenario names and reference-level labels.
ENERGY_TYPES = ("ELECTRICITY", "GAS")
SCENARIO_NAMES = ("standard", "aggressive", "conservative")
LEVEL_LABELS = ("low", "medium", "high", "max")


@dataclass(frozen=True)
class PricingParams:
    # Default variable values of the reference model.
    electricity_margin_ct_per_kwh: float = 1.5
    gas_margin_ct_per_kwh: float = 0.5
    electricity_margin_aggressive_ct_per_kwh: float = 0.8
    gas_margin_aggressive_ct_per_kwh: float = 0.2
    electricity_margin_conservative_ct_per_kwh: float = 2.5
    gas_margin_conservative_ct_per_kwh: float = 1.0
    electricity_standing_charge_margin_eur_per_year: float = 10.0
    gas_standing_charge_margin_eur_per_year: float = 5.0
    consumption_level_low_kwh: int = 1000
    consumption_level_medium_kwh: int = 2000
    consumption_level_high_kwh: int = 4500
    consumption_level_max_kwh: int = 12000
    gas_consumption_level_low_kwh: int = 5000
    gas_consumption_level_medium_kwh: int = 12000
    gas_consumption_level_high_kwh: int = 22000
    gas_consumption_level_max_kwh: int = 40000
    electricity_signup_bonus_eur: float = 100.0
    gas_signup_bonus_eur: float = 140.0

    # Fixed values hard-coded in the reference SQL, parameters here.
    bonus_cap_share: float = 0.15
    margin_floor_eur_per_kwh: float = 0.0
    top_k: int = 3
    baseline_scenario: str = "standard"
    days_per_week: float = 7.0
    days_per_month: float = 30.0
    postcode_width: int = 5

    # Label our own offers carry in the market analysis (our own choice).
    own_provider: str = "In-house"

    def replace(self, **changes) -> "PricingParams":
        return dataclasses.replace(self, **changes)

    @classmethod
    def from_vars(cls, overrides: dict) -> "PricingParams":
        """Build from a ``{name: value}`` override map; unknown names fail loudly."""
        known = {f.name for f in dataclasses.fields(cls)}
        unknown = sorted(set(overrides) - known)
        if unknown:
            raise KeyError(f"unknown pricing parameters: {unknown}")
        return cls().replace(**overrides)

    # ---- lookups derived from the parameters -------------------------------------

    def scenarios(self) -> list[tuple[str, float, float]]:
        """(scenario, electricity margin ct/kWh, gas margin ct/kWh)."""
        return [
            ("standard", float(self.electricity_margin_ct_per_kwh), float(self.gas_margin_ct_per_kwh)),
            ("aggressive", float(self.electricity_margin_aggressive_ct_per_kwh),
             float(self.gas_margin_aggressive_ct_per_kwh)),
            ("conservative", float(self.electricity_margin_conservative_ct_per_kwh),
             float(self.gas_margin_conservative_ct_per_kwh)),
        ]

    def levels(self) -> list[tuple[str, int, str]]:
        """(energy_type, reference consumption kWh, label), eight rows."""
        elec = (self.consumption_level_low_kwh, self.consumption_level_medium_kwh,
                self.consumption_level_high_kwh, self.consumption_level_max_kwh)
        gas = (self.gas_consumption_level_low_kwh, self.gas_consumption_level_medium_kwh,
               self.gas_consumption_level_high_kwh, self.gas_consumption_level_max_kwh)
        rows = [(ELECTRICITY, int(k), lab) for k, lab in zip(elec, LEVEL_LABELS)]
        rows += [(GAS, int(k), lab) for k, lab in zip(gas, LEVEL_LABELS)]
        return rows

    def standing_margin(self, energy_type: str) -> float:
        if energy_type == ELECTRICITY:
            return float(self.electricity_standing_charge_margin_eur_per_year)
        return float(self.gas_standing_charge_margin_eur_per_year)

    def target_bonus(self, energy_type: str) -> float:
        if energy_type == ELECTRICITY:
            return float(self.electricity_signup_bonus_eur)
        return float(self.gas_signup_bonus_eur)


DEFAULT_PARAMS = PricingParams()
