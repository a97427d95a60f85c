"""Domain pack: dimension and fact builders over Silver tables.

Every builder is ``fn(silver, gold, as_of) -> DataFrame``: ``silver`` maps a
flat Silver name (``"aasbs_loa"``) to a DataFrame, ``gold`` maps already
built Gold tables (``"common.dim_agency"``) for key resolution. Builders are
pure DataFrame plans; writing, conforming and auditing are the caller's.
"""

from collections.abc import Mapping

from gildhall.plans.domain.air_facts import fact_accrual_income
from gildhall.plans.domain.alt_facts import fact_award_lifecycle
from gildhall.plans.domain.alt_fre import (
    dim_acquisition, dim_closeout, dim_contractor, dim_fpds_agency, dim_fpds_award, dim_fpds_contractor,
    dim_fpds_psc, dim_solicitation,
)
from gildhall.plans.domain.cat_facts import fact_lifecycle_event
from gildhall.plans.domain.blocked import fact_review_determination, fact_role_assignment
from gildhall.plans.domain.common import (
    dim_agency, dim_award, dim_date, dim_funding, dim_ia, dim_line_item, dim_loa,
)
from gildhall.plans.domain.fre_facts import fact_fpds_transaction
from gildhall.plans.domain.iat_facts import fact_ia_amendment, fact_ia_review
from gildhall.plans.domain.iat_smi import dim_fin_code_history, dim_piid, dim_posting_type, dim_reviewer
from gildhall.plans.domain.lookups import (
    dim_accrual_period, dim_amend_action, dim_cost_rate_type, dim_entity_type, dim_event_type, dim_finding,
    dim_responsible_role, dim_review_type, dim_reviewer_type,
)
from gildhall.plans.domain.oet import fact_obligation_expenditure
from gildhall.plans.domain.psc import dim_billing_period, dim_clin_subtype
from gildhall.plans.domain.psc_facts import fact_clin_pricing, fact_service_charge_schedule
from gildhall.plans.domain.ref import ref_code_tables
from gildhall.plans.domain.smi_facts import fact_solicitation_response
from gildhall.plans.domain.tpp_air import (
    dim_aac_envelope, dim_agreement, dim_onefund_program, dim_receiving_report, dim_transmittal_type,
)
from gildhall.plans.domain.tpp_facts import fact_payment_reconciliation, fact_transmission_event
from gildhall.plans.domain.wpr import dim_client, dim_industry_partner, dim_org_hierarchy, dim_user
from gildhall.session import stored

BUILDERS = {
    "common.dim_date": dim_date,
    "common.dim_agency": dim_agency,
    "common.dim_ia": dim_ia,
    "common.dim_loa": dim_loa,
    "common.dim_award": dim_award,
    "common.dim_funding": dim_funding,
    "common.dim_line_item": dim_line_item,
    "oet.fact_obligation_expenditure": fact_obligation_expenditure,
    "cat.dim_event_type": dim_event_type,
    "cat.dim_review_type": dim_review_type,
    "cat.dim_reviewer_type": dim_reviewer_type,
    "cat.dim_finding": dim_finding,
    "iat.dim_amend_action": dim_amend_action,
    "psc.dim_cost_rate_type": dim_cost_rate_type,
    "wpr.dim_responsible_role": dim_responsible_role,
    "wpr.dim_entity_type": dim_entity_type,
    "air.dim_accrual_period": dim_accrual_period,
    "wpr.dim_user": dim_user,
    "wpr.dim_client": dim_client,
    "wpr.dim_industry_partner": dim_industry_partner,
    "wpr.dim_org_hierarchy": dim_org_hierarchy,
    "psc.dim_clin_subtype": dim_clin_subtype,
    "psc.dim_billing_period": dim_billing_period,
    "iat.dim_reviewer": dim_reviewer,
    "iat.dim_fin_code_history": dim_fin_code_history,
    "smi.dim_posting_type": dim_posting_type,
    "smi.dim_piid": dim_piid,
    "alt.dim_contractor": dim_contractor,
    "alt.dim_acquisition": dim_acquisition,
    "alt.dim_solicitation": dim_solicitation,
    "alt.dim_closeout": dim_closeout,
    "fre.dim_fpds_psc": dim_fpds_psc,
    "fre.dim_fpds_agency": dim_fpds_agency,
    "fre.dim_fpds_contractor": dim_fpds_contractor,
    "fre.dim_fpds_award": dim_fpds_award,
    "tpp.dim_transmittal_type": dim_transmittal_type,
    "tpp.dim_aac_envelope": dim_aac_envelope,
    "tpp.dim_agreement": dim_agreement,
    "tpp.dim_receiving_report": dim_receiving_report,
    "air.dim_onefund_program": dim_onefund_program,
    "wpr.fact_role_assignment": fact_role_assignment,
    "cat.fact_review_determination": fact_review_determination,
    "iat.fact_ia_amendment": fact_ia_amendment,
    "iat.fact_ia_review": fact_ia_review,
    "psc.fact_service_charge_schedule": fact_service_charge_schedule,
    "psc.fact_clin_pricing": fact_clin_pricing,
    "tpp.fact_transmission_event": fact_transmission_event,
    "tpp.fact_payment_reconciliation": fact_payment_reconciliation,
    "smi.fact_solicitation_response": fact_solicitation_response,
    "cat.fact_lifecycle_event": fact_lifecycle_event,
    "air.fact_accrual_income": fact_accrual_income,
    "alt.fact_award_lifecycle": fact_award_lifecycle,
    "fre.fact_fpds_transaction": fact_fpds_transaction,
    "ref.lu_code_tables": ref_code_tables,
}

# Build order of the first product (dimensions before the fact that resolves them).
DP1_ORDER = ["common.dim_date", "common.dim_agency", "common.dim_ia", "common.dim_loa", "common.dim_award",
             "common.dim_funding", "common.dim_line_item", "oet.fact_obligation_expenditure"]


class LazyGold(Mapping):
    """Gold tables built on first access.

    A builder's own reads of ``gold`` build what it needs first, so asking for
    one target builds exactly its dependency closure, in dependency order,
    each table once. ``materialise(name, df) -> df`` is applied to every built
    table (the production path writes it, tests checkpoint it).
    """

    def __init__(self, silver, as_of: str, materialise=None, builders=None):
        self._silver = silver
        self._as_of = as_of
        self._materialise = materialise
        self._builders = builders or BUILDERS
        self._built: dict = {}
        self._building: list[str] = []
        self.step = stored if materialise else None     # how builders cut their plans (``steps.step``)

    def _make(self, name: str):
        if name not in self._builders:
            raise KeyError(name)
        if name in self._building:
            raise ValueError("dependency cycle: " + " -> ".join([*self._building, name]))
        self._building.append(name)
        try:
            return self._builders[name](self._silver, self, self._as_of)
        finally:
            self._building.pop()

    def __getitem__(self, name: str):
        if name not in self._built:
            df = self._make(name)
            self._built[name] = self._materialise(name, df) if self._materialise else df
        return self._built[name]

    def plan(self, name: str):
        """``name`` with everything it reads built first; the target itself is
        returned as a plan for the caller to write, not materialised."""
        return self._built[name] if name in self._built else self._make(name)

    def __contains__(self, name) -> bool:
        return name in self._builders

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def built(self) -> list[str]:
        """Names built so far, in build order."""
        return list(self._built)


def build_all(silver, as_of: str, order=DP1_ORDER, materialise=None):
    """Build targets in order; each built table is visible to the next.

    ``materialise(name, df) -> df`` may write and re-read each target (the
    production path); by default tables stay lazy plans.
    """
    gold: dict = {}
    for name in order:
        df = BUILDERS[name](silver, gold, as_of)
        gold[name] = materialise(name, df) if materialise else df
    return gold
